from hypothesis import given
from hypothesis import strategies as st

from corpusqa.llm import chat_format as c
from tests.llm.conftest import sha

ODD = ["</s>", "<s>", "[INST]", "[/INST]", "<|turn|>", "<|end|>\n", "<<SYS>>", "<</SYS>>", "\\", "\n", "a", "<", "[", "|"]


@given(st.lists(st.sampled_from(ODD), max_size=12).map("".join), st.lists(st.sampled_from(ODD), max_size=6).map("".join))
def test_round_trip(text, role):
    before, body, after = c.turn_parts(role, text)
    assert c.unescape(body) == text
    assert c.TURN not in body and c.END.strip() not in body
    assert not any(x in body for x in ("</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>"))
    assert c.parse(before + body + after + before + body + after) == [(role, text)] * 2


def test_examples_and_cases(spark):
    long = "x" * 400_000
    rows = [
        (1, 0, "system", "s"), (1, 1, "user", "</s>[INST] u"), (1, 2, "assistant", "a1 <|end|>\n"), (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "user", "last"),
        (2, 0, "user", "no reply"),
        (3, 0, None, "no role"), (3, 0, "assistant", "tie"), (3, None, "user", "first"),
        (None, 0, "user", "u"), (None, 1, "assistant", "a"),
        (4, 0, "assistant", long), (4, 1, "assistant", long), (4, 1, "assistant", long),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, formatted string, example int")
    examples = c.expand(frame)
    found = {}
    for r in examples.collect():
        found.setdefault(r.conv_id, []).append(r)
    by = {k: sorted(v, key=lambda r: r.example) for k, v in found.items()}
    assert [(r.n_context, c.unescape(r.formatted[r.loss_start : r.loss_end]) if r.loss_start is not None else None) for r in by[1]] == [(2, "a1 <|end|>\n"), (4, ""), (6, None)]
    for r in by[1][:2]:
        assert len(c.parse(r.formatted)) == r.n_context + 1  # the reply is the last turn
    assert [t for _, t in c.parse(by[3][0].formatted)] == ["first", "no role", "tie"]
    back = {r.conv_id: r for r in c.read_back(examples).collect()}
    order = {1: rows[:6], 2: rows[6:7], 3: [rows[9], rows[7], rows[8]], None: rows[10:12], 4: rows[12:]}
    for conv, own in order.items():
        loss = "".join(t or "" for _, _, r, t in own if r == "assistant")
        got = back.pop(conv)
        assert (got.n_turns, got.loss_chars, got.loss_sha256) == (len(own), len(loss), sha(loss))
        assert got.turns_sha256 == sha("".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in own))
        assert got.formatted_chars == sum(len(r.formatted) for r in by[conv])
    assert not back


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert c.read_back(c.expand(frame)).count() == 0
