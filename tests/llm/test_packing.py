import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from tokenizers import Tokenizer

from rollbook.llm import packing
from rollbook.llm.queries import op10_best_fit_packing, tokenizer_file


@pytest.fixture(scope="module")
def words():
    return packing.WordTokenizer(tokenizer_file())


@pytest.fixture(scope="module")
def fresh():
    """The tokenizer as its file gives it, apart from what the operator does with it."""
    return Tokenizer.from_file(tokenizer_file())


def test_word_ids_equal_the_tokenizers(words, fresh, monkeypatch):
    rng = random.Random(3)
    stock = list("ab sStT''  \n\t12.,!é\xa0\x85rel vmd") + ["'s", "'ll", " '", "'re", "''s", "<|endoftext|>", "日本", "é"]
    texts = ["".join(rng.choice(stock) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    for text, ids in zip(texts, words.encode(texts), strict=True):
        assert fresh.encode(text, add_special_tokens=False).ids == ids.tolist(), text
    monkeypatch.setattr(packing, "STEP_CHARS", 200)  # long texts in parts
    texts = ["".join(rng.choice(stock) for _ in range(3000)) for _ in range(10)] + ["x" * 3000]
    for text, ids in zip(texts, words.encode(texts), strict=True):
        assert fresh.encode(text, add_special_tokens=False).ids == ids.tolist()


def verify(rows, texts, fresh):
    """Every document is there once, in order, and sequences are gapless."""
    spans, pieces = {}, {}
    for r in rows:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault((r.row_id if "row_id" in r else r.doc_id), []).append(r)
    for s in spans.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 1024
    for some in pieces.values():
        some.sort(key=lambda r: r.piece)
        text = texts[some[0].doc_id] or ""
        ids = np.array([*fresh.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        assert [r.piece for r in some] == list(range(len(some)))
        assert all(r.length == 1024 for r in some[1:])
        assert sum(r.length for r in some) == len(ids)
        for r in some:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    return len(spans)


def test_awkward_rows(spark, odd_docs, odd_rows, no_docs, fresh):
    rows = packing.pack(packing.tokenise(odd_docs, tokenizer_file()), group_pieces=5).collect()
    verify(rows, {r[0]: r[1] for r in odd_rows}, fresh)
    assert len({r.row_id for r in rows}) == len(odd_rows)
    assert packing.pack(packing.tokenise(no_docs, tokenizer_file())).count() == 0
    ids = packing.tokenise(odd_docs.filter("doc_id = 6"), tokenizer_file(), with_ids=True).first().ids
    assert ids == [*fresh.encode("one").ids, 2]


def test_query_packs_tightly(spark, fresh):
    folder = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    rows = op10_best_fit_packing(spark, folder).collect()
    assert {r.doc_id for r in rows} == set(texts)
    used = verify(rows, texts, fresh)
    assert used <= -(-sum(r.length for r in rows) // 1024) * 1.02 + 1


def test_special_strings_and_rare_codes(words, fresh):
    texts = ["x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|>" * 3, "plain words then 日本 and more words", "日本", "long a b " * 400 + "ж" + " c d" * 400]
    for text, ids in zip(texts, words.encode(texts), strict=True):
        assert fresh.encode(text, add_special_tokens=False).ids == ids.tolist()
    assert words.encode(["x <|endoftext|> y"])[0].tolist().count(50256) == 1
    rare = "some plain words ж some more words here"
    assert "".join(packing.rare_apart(rare)) == rare and len(list(packing.rare_apart(rare))) == 3


def test_another_tokenizer_takes_the_plain_way():
    path = tokenizer_file("word_bpe_49k.json")
    other, words = Tokenizer.from_file(path), packing.WordTokenizer(path)
    assert not words.fast
    for text in ("Two words", "", "it's 12 <|endoftext|> é"):
        assert words.encode([text])[0].tolist() == other.encode(text, add_special_tokens=False).ids


def test_many_new_words_are_found_again(words, fresh, monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 50)
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choices("abcdé", k=rng.randint(1, 9))) for _ in range(80)) for _ in range(60)]
    for text in texts:
        assert words.encode([text])[0].tolist() == fresh.encode(text, add_special_tokens=False).ids


def test_local_search_runs_to_its_end():
    """Afterwards no exchange of the kinds named raises the sum of squared fills."""
    for size in range(1, 60):
        some = [1 + (7 * i * i + 3 * i) % 37 for i in range(size)]
        place = packing.pack_group(some, 40)
        bins = {}
        for i, b in enumerate(place):
            bins.setdefault(b, []).append(some[i])
        assert max(map(sum, bins.values())) <= 40 and len(bins) == max(place) + 1
        if len(bins) > -(-sum(some) // 40):
            assert not any(better(a, b, 40) for k, a in bins.items() for j, b in bins.items() if j != k)


def better(giver, taker, room):
    fill, other = sum(giver), sum(taker)
    gives = [(x,) for x in giver] + list(combinations(giver, 2))
    backs = [(), *((y,) for y in taker)]
    exchanges = [(g, b) for g in gives for b in backs if len(g) == 1 or b]
    exchanges += [((x,), b) for x in giver for b in combinations(taker, 2)]
    moves = [sum(g) - sum(b) for g, b in exchanges]
    return other >= fill and any(m > 0 and other + m <= room for m in moves)


def test_local_search_empties_a_bin():
    """An exchange raises the squared fill; a move empties a bin."""
    size = np.array([6, 3, 5, 5, 4, 2])
    place, free = np.array([0, 0, 1, 2, 1, 2]), np.array([1, 1, 3])
    assert packing.LocalSearch(size, place, free, 10)._pass_on(2)
    fills = np.bincount(place, weights=size)
    assert sum(fills**2) > 9**2 + 9**2 + 7**2 and sum(fills) == 25 and max(fills) <= 10
    assert (10 - fills == free).all()
    size, place, free = np.array([7, 5, 5, 3]), np.array([0, 1, 2, 2]), np.array([3, 5, 2])
    packing.LocalSearch(size, place, free, 10).run()
    assert sorted(np.bincount(place, weights=size, minlength=3).tolist()) == [0, 10, 10]
