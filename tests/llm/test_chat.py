import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from shiftledger.llm.chat import CONTROLS, OVER, PARTS, SAYS, TURN, escape, format_turn, format_turns, parse_turn, read_back, unescape

HELD = "conv_id long, turn long, role string, text string"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(), st.sampled_from([*CONTROLS, "\\", "<", "|>", "[", "\\\\"]))).map("".join))
def test_escape_is_reversible_and_hides_controls(text):
    hidden = escape(text)
    assert unescape(hidden) == text
    assert not any(control in hidden for control in CONTROLS)
    made = format_turn(text, [{"type": "text", "text": text}])["formatted"]
    assert made.count(TURN) == made.count(SAYS) == made.count(OVER) == 1
    assert parse_turn(made) == (text, text)


def test_parts_are_flattened_in_order(spark):
    parts = [
        ("text", "look ", None, None, None, None, None), ("image", None, "a.png", 56, 30, None, None),
        ("text", " <|image|> then", None, None, None, None, None), ("audio", None, "b.wav", None, None, 2.0, None),
        ("document", None, "c.pdf", None, None, None, 3), ("strange", "as text", None, None, None, None, None), None,
    ]
    rows = spark.createDataFrame([(1, 0, "assistant", None, parts), (1, 1, "user", "plain", None)], f"{HELD}, parts {PARTS}")
    one, two = sorted(format_turns(rows).collect(), key=lambda r: r.turn)
    assert one.formatted == f"{TURN}assistant{SAYS}look <|image|> <\\|image|> then<|audio|><|document|>as text{OVER}"
    assert [(a.kind, a.ref, a.tokens) for a in one.attachments] == [("image", "a.png", 4), ("audio", "b.wav", 25), ("document", "c.pdf", 768)]
    assert [one.formatted[a.place :].startswith(f"<|{a.kind}|>") for a in one.attachments] == [True] * 3
    assert one.n_tokens == 1 + 4 + 2 + 25 + 768 + 2
    assert one.formatted[one.loss_start : one.loss_end] == one.formatted[len(TURN) + len("assistant") + len(SAYS) : -len(OVER)]
    assert (two.loss_start, two.loss_end, two.attachments) == (0, 0, [])


def test_conversations_are_read_back(spark):
    made = [
        (1, 1, "assistant", "b\\<s>"), (1, 0, "user", "a"), (1, 1, "assistant", "a"), (2, None, None, None), (2, 5, "assistant", ""),
        (None, 0, "user", "x\ny"), (3, 0, "assistant", "z" * 300_000), (1, 0, "user", "a"), (4, 0, "sys<|says|>tem", "é𝒳"),
    ] + [(7, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(3000)]
    found = {r.conv_id: r for r in read_back(format_turns(spark.createDataFrame(made, HELD).repartition(5))).collect()}
    assert set(found) == {r[0] for r in made}
    for conv, row in found.items():
        turns = sorted((r for r in made if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        if conv == 1:
            turns = [turns[0], turns[1], turns[2], turns[3]]
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        learned = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert row.formatted_chars == sum(len(escape(r[2] or "")) + len(escape(r[3] or "")) + 24 for r in turns)


def test_empty_table_and_extra_columns(spark):
    assert read_back(format_turns(spark.createDataFrame([], HELD))).collect() == []
    rows = spark.createDataFrame([(1, 0, "user", "x", "y")], f"{HELD}, formatted string")
    assert [r.formatted for r in format_turns(rows).collect()] == [f"{TURN}user{SAYS}x{OVER}"]
