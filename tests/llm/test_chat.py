import hashlib
import random

import pytest

from stayspark.llm import chat


def made(turns):
    return list(chat.expand(iter(turns)))


@pytest.mark.parametrize("text", ["", " ", "\\", "\\\\", "</turn>", " </turn>\n", "\\</turn>", "### x: y </turn>\n", "a\\### b", "\\### Assistant: </turn> ok", "<", "x <", "é\n\n", ":", "#" * 7])
def test_escape_round_trip(text):
    assert chat.unescape(chat.escape(text)) == text
    for role in ("user", "assistant", "a:b\n###", ""):
        whole = "".join(f"{chat.OPEN}{chat.escape(role, chat.ROLE_CONTROL)}: {chat.escape(text)}{chat.CLOSE}" for _ in range(2))
        assert chat.read_back(whole) == [(role, text)] * 2


def test_random_round_trip():
    r = random.Random(5)
    parts = ["###", "</turn>", "\\", " ", "\n", ":", "a", "<", "/turn>", "é"]
    for _ in range(500):
        turns = [(1, r.choice(["user", "assistant", ":", "\\"]), "".join(r.choices(parts, k=r.randint(0, 8)))) for _ in range(r.randint(1, 6))]
        rows = made(turns)
        assert [row[-1] for row in rows] == [False] * (len(rows) - 1) + [True]
        last = rows[-1][3]
        assert chat.read_back(last) == [(a, b) for _, a, b in turns]
        replies = [b for _, a, b in turns if a == "assistant"]
        trained = [chat.unescape(row[3][row[4] : row[5]]) for row in rows]
        assert "".join(trained) == "".join(replies)
        assert len(rows) == len(replies) + (turns[-1][1] != "assistant")


def test_each_reply_has_all_before_it():
    rows = made([(1, "user", "a"), (1, "assistant", "b"), (1, "user", "c"), (1, "assistant", "d"), (2, "user", "e")])
    assert [(r[0], r[1], r[2]) for r in rows] == [(1, 0, 2), (1, 1, 4), (2, 0, 1)]
    assert rows[1][3].startswith(rows[0][3])
    assert rows[2][4] == rows[2][5]


def test_query_against_brute_force(spark):
    rows = [(1, 1, "assistant", "yes"), (1, 0, "user", None), (2, None, None, "x"), (2, 3, "assistant", ""), (None, 0, "user", "q"), (3, 0, "assistant", "r"), (3, 0, "assistant", "r"), (4, 0, "user", "long " * 40000)]
    df = spark.createDataFrame([(*r, "other") for r in rows], "conv_id long, turn long, role string, text string, example string")
    got = {r["conv_id"]: r for r in chat.digests(chat.examples(df)).collect()}
    for conv in {r[0] for r in rows}:
        turns = [(b or "", c or "") for _, b, c in sorted(((-1 if r[1] is None else r[1], r[2], r[3]) for r in rows if r[0] == conv), key=lambda x: (x[0], x[1] or "", x[2] or ""))]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert got[conv]["n_turns"] == len(turns)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digests(chat.examples(df.limit(0))).count() == 0
