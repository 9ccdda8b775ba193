import random
import re

import pytest
import xxhash

from rollbook.llm import simhash
from rollbook.llm.queries import op13_simhash_near_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    some = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in some]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n, links):
    parent = list(range(n))

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        parent[top(a)] = top(b)
    return [top(i) for i in range(n)]


def plain(rows):
    prints = [plain_print(t) for _, t in rows]
    known = [i for i, (d, _) in enumerate(rows) if d is not None]
    top = groups(len(rows), [(i, j) for i in known for j in known if j < i and (prints[i] ^ prints[j]).bit_count() <= 3])
    least = {}
    for i in known:
        least[top[i]] = min(rows[i][0], least.get(top[i], rows[i][0]))
    return sorted(((d, f"{p:016x}", None if d is None else least[top[i]]) for i, ((d, _), p) in enumerate(zip(rows, prints))), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_majority_counts_many_hashes():
    rng = random.Random(1)
    for n in (1, 2, 3, 254, 255, 256, 1000):
        hashes = [rng.getrandbits(64) & rng.getrandbits(64) if n % 2 else rng.getrandbits(64) for _ in range(n)]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)
        assert simhash.bit_majority(simhash.np.array(hashes, dtype="u8")) == want


def test_anchors_cover():
    rng = random.Random(2)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), 3):
            y ^= 1 << b
        found = [set(simhash.anchors(simhash.np.array([p], dtype="u8"))[1].tolist()) for p in (x, y)]
        assert found[0] & found[1] and max(map(len, found)) <= 32


@pytest.mark.parametrize("hot", [50_000, 20])
def test_dense_clusters(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT", hot)  # 20: many anchors take the joined way
    rng = random.Random(3)
    prints = set()
    for _ in range(25):
        center = rng.getrandbits(64)
        for _ in range(60):
            x = center
            for b in rng.sample(range(64), rng.randrange(7)):
                x ^= 1 << b
            prints.add(x)
    prints = sorted(prints)
    at = {p - (1 << 64) if p >> 63 else p: i for i, p in enumerate(prints)}
    found = simhash.links(spark.createDataFrame([(p,) for p in at], "print long")).collect()
    linked = [(at[r.a], at[r.b]) for r in found]
    assert all((prints[a] ^ prints[b]).bit_count() <= 3 for a, b in linked)
    n = range(len(prints))
    want = groups(len(n), [(i, j) for i in n for j in n if j < i and (prints[i] ^ prints[j]).bit_count() <= 3])
    assert sorted(map(sorted, _classes(groups(len(n), linked)))) == sorted(map(sorted, _classes(want)))


def _classes(top):
    out = {}
    for i, t in enumerate(top):
        out.setdefault(t, []).append(i)
    return out.values()


def test_awkward_rows(odd_docs, odd_rows, no_docs):
    assert got(simhash.near_duplicates(odd_docs)) == plain([(r[0], r[1]) for r in odd_rows])
    assert simhash.near_duplicates(no_docs).count() == 0


def test_clashing_names(odd_docs):
    named = odd_docs.withColumnRenamed("key_", "print").withColumnRenamed("weight", "component_id")
    assert simhash.near_duplicates(named).columns == ["doc_id", "fingerprint", "component_id"]


def test_distance_beyond_the_code(odd_docs):
    with pytest.raises(ValueError):
        simhash.near_duplicates(odd_docs, distance=4)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert got(op13_simhash_near_dedup(spark, folder)) == plain(rows)
