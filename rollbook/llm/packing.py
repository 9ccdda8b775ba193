"""Best-fit packing of tokenised documents, improved by swaps between underfull bins.

Texts are tokenised inside the scan; only piece lengths travel. Pieces as long as a
sequence fill one each. The rest is dealt over groups of a bounded size by a hash of the
row; each group is packed on its own: best fit first, then a local search that moves
documents or swaps one for one and two for one between underfull bins as long as the sum of
squared fills rises, so that nearly empty bins run empty.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import keep

LENGTH = 1024
END_ID = 2
GROUP_PIECES = 16_384  # pieces packed in one task
STEP_CHARS = 1_000_000  # code points tokenised at once, whole texts or parts of them
STEP_ROWS = 500  # rows whose texts are in memory as strings at once
KNOWN_WORDS = 800_000  # distinct words a task remembers
WORDS_AT_ONCE = 2_048  # texts given to the tokenizer in one call
JOINED = 32  # words of one such text
SAFE_CUT = re.compile(r"[A-Za-z](?= [A-Za-z])")
FAST_CODES = 0x250  # code points whose class is looked up; parts with others take the plain way
RARE_CODES = re.compile(f"[^\0-{chr(FAST_CODES - 1)}]+")
# Fixed: how the tokenizer splits texts for which the fast way holds.
SPLITS = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}

# Fixed: the classes of the tokenizer's splitting pattern.
OTHER, LETTER, NUMBER, SPACE = range(4)
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")


def code_classes() -> np.ndarray:
    """Class of each code point below FAST_CODES, as the splitting pattern sees it."""
    import regex

    kinds = np.zeros(FAST_CODES, dtype=np.uint8)
    for code in range(FAST_CODES):
        char = chr(code)
        if regex.match(r"\p{L}", char):
            kinds[code] = LETTER
        elif regex.match(r"\p{N}", char):
            kinds[code] = NUMBER
        elif regex.match(r"\s", char):
            kinds[code] = SPACE
    return kinds


def split_starts(codes: np.ndarray, kinds: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the words begin that the tokenizer's pattern splits joined texts into.

    ``first`` holds the start of every text; no word crosses one. A run of one class is a
    word; a single space joins the run that follows; of several spaces only the last does;
    an apostrophe with a contraction's letters is a word.
    """
    n = len(codes)
    kind = kinds[codes]
    opens = np.zeros(n + 1, dtype=bool)
    opens[first] = True
    opens[n] = True
    text_start = opens.copy()
    opens[1:n] |= kind[1:] != kind[:-1]

    space = kind == SPACE
    ends = opens[1:]  # the run ends with this code point
    text_ends = text_start[1:]
    last_space = space & ends & ~text_ends  # a run of spaces before other characters
    opens[:n] |= last_space  # the run is split before its last space
    joins = last_space & (codes == 32)  # which then leads the next word
    opens[1:] &= ~joins
    opens[first] = True
    opens[n] = True

    quotes = np.flatnonzero((codes == 39) & opens[:n] & ends)
    for q in quotes:  # rare: only apostrophes that stand alone before a letter
        for tail in CONTRACTIONS:
            stop = q + 1 + len(tail)
            if stop <= n and not text_start[q + 1 : stop].any() and all(
                codes[q + 1 + i] == ord(c) for i, c in enumerate(tail)
            ):
                opens[q + 1 : stop] = False
                opens[stop] = True
                break
    return np.flatnonzero(opens)


class WordTokenizer:
    """Token ids of texts; every distinct word is given to the tokenizer once."""

    base = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        added = self.plain.get_added_tokens_decoder()
        self.added = [t.content for t in added.values()]  # texts with one take the plain way
        self.fast = self._splits_as_known()
        vocab = self.plain.get_vocab(with_added_tokens=False)
        self.width = np.zeros(max([*vocab.values(), *added, 0]) + 1, dtype=np.int64)
        self.width[list(vocab.values())] = [len(t) for t in vocab]  # a byte is spelled as one character
        self.kinds = code_classes()
        self.inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        self.keys = np.zeros(0, dtype=np.uint64)  # sorted hashes of the known words
        self.at = np.zeros(0, dtype=np.int64)  # their ids begin here
        self.size = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)
        self.spelled = np.zeros(0, dtype=np.uint32)  # the words themselves, joined
        self.spelled_at = np.zeros(0, dtype=np.int64)
        self.spelled_size = np.zeros(0, dtype=np.int64)

    def _splits_as_known(self) -> bool:
        """Whether the file holds the pre-tokenizer that ``split_starts`` follows."""
        if self.plain.normalizer is not None or self.plain.pre_tokenizer is None:
            return False
        found = json.loads(self.plain.pre_tokenizer.__getstate__())
        return all(found.get(k) == v for k, v in SPLITS.items())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text as the tokenizer in the file gives them, without those that it adds
        around a text; works in steps of bounded size."""
        parts, owner = [], []
        for i, text in enumerate(texts):
            if not self.fast or any(a in text for a in self.added):
                parts.append(text)
                owner.append(i)
                continue
            for part in safe_parts(text):
                for piece in rare_apart(part):
                    parts.append(piece)
                    owner.append(i)
        found: list[list[np.ndarray]] = [[] for _ in texts]
        start = 0
        while start < len(parts):
            stop, chars = start + 1, len(parts[start])
            while stop < len(parts) and chars + len(parts[stop]) <= STEP_CHARS:
                chars += len(parts[stop])
                stop += 1
            for i, ids in zip(owner[start:stop], self._encode(parts[start:stop]), strict=True):
                found[i].append(ids)
            start = stop
        return [f[0] if len(f) == 1 else np.concatenate(f) for f in found]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        fast, codes = [], []
        for i, text in enumerate(texts):
            c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            if len(c) == 0:
                out[i] = np.zeros(0, dtype=np.uint32)
            elif self.fast and c.max() < FAST_CODES and not any(a in text for a in self.added):
                fast.append(i)
                codes.append(c)
            else:
                out[i] = np.array(
                    self.plain.encode(text, add_special_tokens=False).ids, dtype=np.uint32
                )
        if fast:
            for i, ids in zip(fast, self._encode_fast(codes), strict=True):
                out[i] = ids
        return out

    def _encode_fast(self, parts: list[np.ndarray]) -> list[np.ndarray]:
        lengths = np.array([len(p) for p in parts])
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        codes = np.concatenate(parts)
        starts = split_starts(codes, self.kinds, first)
        keys = self._hash(codes, starts)
        order = np.argsort(keys)
        new = np.append(True, keys[order[1:]] != keys[order[:-1]])
        words, where = keys[order[new]], order[new]
        inverse = np.empty(len(keys), dtype=np.int64)
        inverse[order] = np.cumsum(new) - 1
        if not self._same(codes, starts, where[inverse]):  # a hash collision: the plain way
            text = codes.astype("<u4").tobytes()
            return [
                np.array(
                    self.plain.encode(
                        text[4 * a : 4 * (a + n)].decode("utf-32-le", "surrogatepass"), add_special_tokens=False
                    ).ids,
                    dtype=np.uint32,
                )
                for a, n in zip(first, lengths, strict=True)
            ]
        if not self._known_same(codes, starts, words, where):
            self._forget()
        self._learn(codes, starts, words, where)
        place = np.searchsorted(self.keys, words)[inverse]
        sizes = self.size[place]
        offsets = np.cumsum(sizes) - sizes
        total = int(sizes.sum())
        ids = self.ids[np.repeat(self.at[place] - offsets, sizes) + np.arange(total)]
        text_of = np.searchsorted(first, starts[:-1], side="right") - 1
        per_text = np.bincount(text_of, weights=sizes, minlength=len(parts)).astype(np.int64)
        return np.split(ids, np.cumsum(per_text)[:-1])

    def _hash(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Polynomial hash of every word from one running sum over all characters."""
        lengths = np.diff(starts)
        within = np.arange(len(codes), dtype=np.int32)
        within -= np.repeat(starts[:-1].astype(np.int32), lengths)
        top = int(within.max()) + 1
        powers = np.full(top, self.base, dtype=np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers)
        terms = (codes.astype(np.uint64) + np.uint64(1)) * powers[within]
        hashes = np.add.reduceat(terms, starts[:-1])
        hashes ^= hashes >> np.uint64(31)
        return hashes * np.uint64(0xBF58476D1CE4E5B9) + lengths.astype(np.uint64)

    @staticmethod
    def _same(codes: np.ndarray, starts: np.ndarray, twin: np.ndarray) -> bool:
        """Every word equals, letter by letter, the word that stands for its hash."""
        lengths = np.diff(starts)
        if not np.array_equal(lengths, lengths[twin]):
            return False
        shift = np.repeat((starts[twin] - starts[:-1]).astype(np.int32), lengths)
        shift += np.arange(len(codes), dtype=np.int32)
        return np.array_equal(codes, codes[shift])

    def _word_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, joined, and how many each has.

        Words of a space and letters are given to the tokenizer many at a time, as one
        text, which it splits into the same words again.
        """
        joins = np.fromiter((t[0] == " " and t[1:].isalpha() for t in texts), bool, len(texts))
        found: list[np.ndarray] = [np.zeros(0, np.uint32)]
        sizes = np.zeros(len(texts), dtype=np.int64)
        order = np.concatenate([np.flatnonzero(joins), np.flatnonzero(~joins)])
        many = int(joins.sum())
        for at in range(0, many, WORDS_AT_ONCE * JOINED):
            some = order[at : min(many, at + WORDS_AT_ONCE * JOINED)]
            joined = ["".join([texts[i] for i in some[k : k + JOINED]]) for k in range(0, len(some), JOINED)]
            every = [e.ids for e in self.plain.encode_batch_fast(joined, add_special_tokens=False)]
            ids = np.fromiter(chain.from_iterable(every), np.uint32)
            # no token crosses words: their ends in bytes are ends of tokens too
            ends = np.cumsum(self.width[ids])
            words = np.cumsum([len(texts[i].encode()) for i in some])
            last = np.searchsorted(ends, words)
            if not len(ids) or ends[-1] != words[-1] or (ends[last] != words).any():
                raise ValueError("the tokenizer splits joined words otherwise")
            sizes[some] = np.diff(last, prepend=-1)
            found.append(ids)
        for at in range(many, len(texts), WORDS_AT_ONCE):
            some = order[at : at + WORDS_AT_ONCE]
            part = self.plain.encode_batch_fast([texts[i] for i in some], add_special_tokens=False)
            ids = [e.ids for e in part]
            sizes[some] = [len(x) for x in ids]
            found.append(np.fromiter(chain.from_iterable(ids), np.uint32))
        ids = np.concatenate(found)
        # back to the order of the words
        begin = np.zeros(len(texts), dtype=np.int64)
        begin[order] = np.cumsum(sizes[order]) - sizes[order]
        shift = np.cumsum(sizes) - sizes
        return ids[np.repeat(begin - shift, sizes) + np.arange(len(ids))], sizes

    def _known_same(
        self, codes: np.ndarray, starts: np.ndarray, words: np.ndarray, where: np.ndarray
    ) -> bool:
        """Words met before are spelled as they were then."""
        old = np.isin(words, self.keys, assume_unique=True)
        place = np.searchsorted(self.keys, words[old])
        at, stop = starts[where[old]], starts[where[old] + 1]
        size = self.spelled_size[place]
        if not np.array_equal(stop - at, size):
            return False
        within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        now = codes[np.repeat(at, size) + within]
        return np.array_equal(now, self.spelled[np.repeat(self.spelled_at[place], size) + within])

    def _forget(self) -> None:
        self.keys = self.keys[:0]
        self.at, self.size = self.at[:0], self.size[:0]
        self.spelled_at, self.spelled_size = self.spelled_at[:0], self.spelled_size[:0]
        self.ids, self.spelled = self.ids[:0], self.spelled[:0]

    def _learn(
        self, codes: np.ndarray, starts: np.ndarray, words: np.ndarray, where: np.ndarray
    ) -> None:
        if len(self.keys) > KNOWN_WORDS:
            self._forget()
        new = ~np.isin(words, self.keys, assume_unique=True)
        if not new.any():
            return
        at, stop = starts[where[new]], starts[where[new] + 1]
        text = codes.tobytes().decode("utf-32-le", "surrogatepass")
        texts = [text[a:b] for a, b in zip(at.tolist(), stop.tolist(), strict=True)]
        ids, sizes = self._word_ids(texts)
        ids_at = len(self.ids) + np.cumsum(sizes) - sizes
        length = stop - at
        shift = np.cumsum(length) - length
        spelled = codes[np.repeat(at - shift, length) + np.arange(int(length.sum()))]
        # both are sorted: the new words go in between
        to = np.searchsorted(self.keys, words[new])
        self.keys = np.insert(self.keys, to, words[new])
        self.at = np.insert(self.at, to, ids_at)
        self.size = np.insert(self.size, to, sizes)
        self.ids = np.concatenate([self.ids, ids])
        self.spelled_at = np.insert(self.spelled_at, to, len(self.spelled) + shift)
        self.spelled_size = np.insert(self.spelled_size, to, length)
        self.spelled = np.concatenate([self.spelled, spelled])


def safe_parts(text: str) -> Iterator[str]:
    """A long text in parts that are tokenised alike on their own.

    A cut lies before a space between two ASCII letters, where a word begins in any case;
    without such a place the part runs on.
    """
    at = 0
    while len(text) - at > STEP_CHARS // 4:
        cut = SAFE_CUT.search(text, at + STEP_CHARS // 8)
        if not cut:
            break
        yield text[at : cut.start() + 1]
        at = cut.start() + 1
    yield text[at:]


def rare_apart(text: str) -> Iterator[str]:
    """A text cut at safe places so that rare code points stand in small parts of their own."""
    try:
        text.encode("latin-1")  # quickly tells most texts without any
        found = None
    except UnicodeEncodeError:
        found = RARE_CODES.search(text)
    if not found:
        yield text
        return
    cuts = [m.start() + 1 for m in SAFE_CUT.finditer(text)]
    at = 0
    for rare in RARE_CODES.finditer(text):
        if rare.start() < at:
            continue  # in the part before
        k = bisect.bisect_right(cuts, rare.start())
        begin = cuts[k - 1] if k else 0
        stop = cuts[k] if k < len(cuts) else len(text)
        if begin > at:
            yield text[at:begin]
        yield text[max(at, begin) : stop]
        at = stop
    if at < len(text):
        yield text[at:]


def pack_group(lengths: list[int], room: int) -> list[int]:
    """Bin of each piece: best fit in descending order, then the local search."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    by_free: list[list[int]] = [[] for _ in range(room + 1)]
    open_sizes = 0  # bit f is set if some bin has f tokens free
    place = np.zeros(len(lengths), dtype=np.int64)
    free: list[int] = []
    for i in order:
        need = lengths[i]
        fits = open_sizes >> need
        if fits:
            size = need + (fits & -fits).bit_length() - 1
            b = by_free[size].pop()
            if not by_free[size]:
                open_sizes &= ~(1 << size)
        else:
            b, size = len(free), room
            free.append(room)
        place[i] = b
        free[b] = size - need
        if free[b]:
            by_free[free[b]].append(b)
            open_sizes |= 1 << free[b]
    LocalSearch(np.array(lengths, dtype=np.int64), place, np.array(free, dtype=np.int64), room).run()
    return np.unique(place, return_inverse=True)[1].tolist()


class LocalSearch:
    """Moves and swaps between underfull bins, each raising the sum of squared fills.

    A giver passes tokens on to a bin that is at least as full: a piece, one or two pieces for
    one, or one for two. Of all exchanges of a giver the one that passes on most is made, until
    no giver has any, or as few bins are left as the pieces fill.
    """

    def __init__(self, size: np.ndarray, place: np.ndarray, free: np.ndarray, room: int):
        self.size, self.place, self.free, self.room = size, place, free, room
        self.least = -(-int(size.sum()) // room)
        self.used = len(free)

    def run(self) -> None:
        better = True
        while better:
            better = False
            for giver in np.argsort(-self.free, kind="stable"):
                while self.used > self.least and 0 < self.free[giver] < self.room and self._pass_on(giver):
                    better = True

    def _pass_on(self, giver: int) -> bool:
        room_left = self.free[self.place]
        mine = self._distinct(np.flatnonzero(self.place == giver))
        takers = (self.place != giver) & (room_left > 0) & (room_left <= self.free[giver])
        theirs = np.flatnonzero(takers)
        if not len(theirs):
            return False
        nothing = np.zeros(len(theirs), dtype=np.int64)
        best: tuple = (0,)
        for out in [(i,) for i in mine] + self._pairs(mine):
            total = int(self.size[list(out)].sum())
            if len(out) == 1:
                best = max(best, self._fit(total, out, nothing, room_left[theirs], theirs[:, None], moved=True))
            best = max(best, self._fit(total, out, self.size[theirs], room_left[theirs], theirs[:, None]))
        two = self._taker_pairs(theirs)
        if len(two):
            for i in mine:
                total = int(self.size[i])
                both = self.size[two].sum(axis=1)
                best = max(best, self._fit(total, (i,), both, room_left[two[:, 0]], two))
        if not best[0]:
            return False
        gain, out, back, taker = best
        self.place[list(out)] = taker
        self.place[list(back)] = giver
        self.free[taker] -= gain
        self.free[giver] += gain
        self.used -= int(self.free[giver] == self.room)
        return True

    def _fit(self, total, out, given, left, rows, moved=False) -> tuple:
        """The taker's pieces that leave least space when ``out`` comes for them."""
        gain = total - given
        gain = np.where((gain > 0) & (gain <= left), gain, 0)
        k = int(gain.argmax())
        if not gain[k]:
            return (0,)
        return int(gain[k]), out, () if moved else tuple(rows[k].tolist()), int(self.place[rows[k, 0]])

    def _distinct(self, pieces: np.ndarray) -> list[int]:
        """Up to two pieces of each size: more of a bin's equal ones offer nothing new."""
        order = pieces[np.argsort(self.size[pieces], kind="stable")]
        third = np.zeros(len(order), dtype=bool)
        third[2:] = self.size[order[2:]] == self.size[order[:-2]]
        return order[~third].tolist()

    @staticmethod
    def _pairs(pieces: list[int]) -> list[tuple[int, int]]:
        return [(i, j) for n, i in enumerate(pieces) for j in pieces[n + 1 :]]

    def _taker_pairs(self, pieces: np.ndarray) -> np.ndarray:
        """Pairs of pieces of one bin, of all bins, as rows."""
        order = pieces[np.lexsort((self.size[pieces], self.place[pieces]))]
        third = np.zeros(len(order), dtype=bool)
        third[2:] = (self.size[order[2:]] == self.size[order[:-2]]) & (self.place[order[2:]] == self.place[order[:-2]])
        order = order[~third]
        found = []
        for shift in range(1, len(order)):
            same = self.place[order[shift:]] == self.place[order[:-shift]]
            if not same.any():
                break
            found.append(np.stack([order[:-shift][same], order[shift:][same]], axis=1))
        return np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)


def _cut(
    carried: pa.RecordBatch, encoded: list[np.ndarray], length: int, with_ids: bool
) -> pa.RecordBatch:
    """The pieces of each row's ids: all of ``length`` tokens, but for the first."""
    row, piece, start, size, crc, ids = [], [], [], [], [], []
    for i, found in enumerate(encoded):
        every = np.append(found, np.uint32(END_ID)).astype("<u4")
        head = len(every) - (-(-len(every) // length) - 1) * length
        cuts = [0, *range(head, len(every) + 1, length)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            row.append(i)
            piece.append(k)
            start.append(a)
            size.append(b - a)
            crc.append(zlib.crc32(every[a:b].tobytes()))
            if with_ids:
                ids.append(every[a:b].astype(np.int32))
    out = carried.take(pa.array(row, pa.int64()))
    columns = [*out.columns, pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
               pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
    names = [*out.schema.names, "piece", "start", "length", "ids_crc32"]
    if with_ids:
        columns.append(pa.array(ids, pa.list_(pa.int32())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names)


def tokenise(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, *carry: Column, with_ids: bool = False
) -> DataFrame:
    """One row per piece: row_id, carried columns (default doc_id), piece, start, length, ids_crc32.

    A document's ids are its text's, then END_ID. Documents longer than ``length`` are cut
    from the end, so that only the first piece may be shorter. A null text is empty.
    ``with_ids`` adds the ids themselves (array of int).
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        *(carry or (F.col("doc_id"),)),
        F.coalesce("text", F.lit("")).alias("text_"),
    )
    carried = rows.schema.fields[:-1]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores in use already
        words = WordTokenizer(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP_ROWS):
                part = batch.slice(at, STEP_ROWS)
                texts = part.column("text_").to_pylist()
                yield _cut(part.drop_columns("text_"), words.encode(texts), length, with_ids)

    more = ", ids array<int>" if with_ids else ""
    return rows.mapInArrow(
        run, f"{columns}, piece int, start long, length long, ids_crc32 long{more}"
    )


def pack(pieces: DataFrame, room: int = LENGTH, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (see ``tokenise``) with sequence_id and offset.

    Needs row_id, piece, length; other columns are carried along. Pieces of ``room`` tokens
    have a sequence of their own, with a negative id. Others share sequences, gapless from
    offset 0; each group loses less than one sequence against packing all at once. Repeated
    rows are packed one by one. An empty table gives no rows.
    """
    pieces = keep(pieces, "pieces")
    alone = pieces.filter(F.col("length") >= room).select(
        "*",
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    short = pieces.filter(F.col("length") < room)
    groups = max(1, -(-short.count() // group_pieces))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["row_id", "piece"], ignore_index=True)
        group = int(part.pop("group_").iloc[0])
        part["sequence_id"] = np.array(pack_group(part["length"].tolist(), room), dtype=np.int64)
        part["offset"] = part.groupby("sequence_id")["length"].cumsum() - part["length"]
        part["sequence_id"] += group << 32
        return part

    shared = (
        short.withColumn(
            "group_", F.pmod(F.xxhash64("row_id", "piece"), F.lit(groups)).cast("int")
        )
        .groupBy("group_")
        .applyInPandas(run, f"{schema}, sequence_id long, offset long")
    )
    return alone.unionByName(shared)
