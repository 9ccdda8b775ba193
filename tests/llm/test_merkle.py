import hashlib
import zlib

import numpy as np
import pytest

from compare import connect, differences
from rollbook.llm import merkle
from rollbook.llm.oracles import OP12
from rollbook.llm.queries import op12_merkle_manifest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        n = levels[-1]
        levels.append([sha("".join(n[i : i + 8])) for i in range(0, len(n), 8)])
    return levels


def plain_manifest(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r["lang"], []).append((r["doc_id"], leaf(r, r["text"]), r))
    for nodes in trees.values():
        nodes.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    low = {n: levels_of([x[1] for x in trees[n]]) for n in names}
    high = levels_of([low[n][-1][0] for n in names])
    root, out = high[-1][0], []
    for at, name in enumerate(names):
        for k, (doc_id, digest, r) in enumerate(trees[name]):
            text = r["text"]
            if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
                text = text.translate(LOWER)
            folded, siblings = leaf(r, text), []
            for levels, place in ((low[name], k), (high, at)):
                for nodes in levels[:-1]:
                    head, p = place // 8 * 8, place % 8
                    run = nodes[head : head + 8]
                    siblings += run[:p] + run[p + 1 :]
                    folded = sha("".join([*run[:p], folded, *run[p + 1 :]]))
                    place //= 8
            out.append((doc_id, digest, low[name][-1][0], root, sha("".join(siblings)), folded, folded == root))
    return sorted(out, key=str)


def got(docs):
    return sorted((tuple(r) for r in merkle.manifest(docs).collect()), key=str)


@pytest.mark.parametrize("entries", [1, 2, 7, 8, 9, 63, 64, 65, 100, 511, 512])
def test_positions_are_those_of_a_postorder_walk(entries):
    levels, walk = merkle.height(entries), {}

    def visit(level, node):
        if level:
            width = merkle.FAN ** (level - 1)
            for child in range(node * merkle.FAN, (node + 1) * merkle.FAN):
                if child * width < entries:
                    visit(level - 1, child)
        walk[level, node] = len(walk)

    visit(levels, 0)
    found = merkle.node_positions(entries, levels)
    assert {(lv, k): int(p) for lv, at in enumerate(found) for k, p in enumerate(at)} == walk
    assert np.array_equal(found[0], merkle.leaf_position(np.arange(entries)))


def test_awkward_rows(odd_docs, no_docs):
    rows = [r.asDict() for r in odd_docs.collect()]
    assert got(odd_docs) == plain_manifest(rows)
    assert merkle.manifest(no_docs).count() == 0


def test_small_builders_and_many_copies(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)  # eight entries a builder: four rounds
    langs = ["en", None, "", "éa", "z", *[f"l{i:02}" for i in range(12)]]
    rows = [(i, f"Text {i}", langs[0 if i % 3 else i % len(langs)], "s", i) for i in range(900)]
    rows += [(5000, "Copy", "en", "s", 4)] * 700 + [(None, "No id", "en", None, None)] * 9
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = plain_manifest([r.asDict() for r in docs.collect()])
    assert got(docs.repartition(7)) == want
    assert got(docs.coalesce(1)) == want


def test_one_row(spark):
    docs = spark.createDataFrame([(3, "Abc", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    row = merkle.manifest(docs).first()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == sha("")


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    found = op12_merkle_manifest(spark, folder)
    assert differences(found, connect(folder), OP12) == []
    assert 0 < found.filter("not verified").count() < found.count() / 2
