import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from rollbook.llm import chat
from rollbook.llm.queries import op9_chat_format

TEXT = st.text(alphabet="<|\\>nturnd\n/é", max_size=30)


@given(TEXT)
def test_escaping_is_reversible(text):
    t = chat.Template()
    assert t.reveal(t.guard(text)) == text
    assert t.role_of(t.header(text)) == text
    assert "<|" not in t.guard(text).replace("\\<|", "")


def brute(rows):
    out = {}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    for conv, _, role, text in order:
        out.setdefault(conv, []).append((role or "", text or ""))
    return {
        c: (
            len(turns),
            hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            sum(len(t) for r, t in turns if r == "assistant"),
            hashlib.sha256("".join(t for r, t in turns if r == "assistant").encode()).hexdigest(),
        )
        for c, turns in out.items()
    }


def test_round_trip(spark):
    rows = [
        (1, 0, "system", "be brief"), (1, 1, "user", "<|turn|>user\nhi<|end|>"), (1, 2, "assistant", "a\\<|b"),
        (2, 0, "assistant", "first"), (2, 1, "user", None), (3, 0, "user", "alone"),
        (None, 0, "user", "x"), (None, 1, "assistant", "y" * 200_000),
        (4, 0, None, "no role"), (4, 0, None, "no role"), (4, None, "user\n|>", ""),
        (5, 0, "user", "q"), (5, 1, "assistant", ""), (5, 1, "assistant", "tie"),
    ]
    df = spark.createDataFrame([(*r, 0, "z") for r in rows], "conv_id long, turn long, role string, text string, segment int, part string")
    segments = chat.format_chats(df.repartition(4))
    got = {r.conv_id: r for r in chat.read_back(segments).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    for conv, (n, turns, chars, loss) in want.items():
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (n, turns, chars, loss)
    assert {c for c, r in got.items() if r.valid} == {1, None}
    parts = segments.filter("conv_id = 1").orderBy("segment").collect()
    assert [p.loss for p in parts] == [False] * 7 + [True, False]
    assert "".join(p.text for p in parts).count("<|turn|>") == 4  # three marks, one escaped


def test_errors_are_named(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "x"), (2, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    errors = {r.conv_id: r.error for r in chat.format_chats(df).filter("error is not null").collect()}
    assert errors == {1: "'assistant' after start", 2: "unfinished"}


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_chats(none)).count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    rows = op9_chat_format(spark, folder).filter("conv_id = -7").collect()
    assert rows[0].loss_chars == 21 and rows[0].n_turns == 2
