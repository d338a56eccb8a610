"""Formatted turns: escapes that come back, masks, attachments, digests."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pointlake.llm import chat

TURNS = "conv_id bigint, turn bigint, role string, text string, formatted string, n_turns string"
SAID = r"\### Assistant: </turn> ok"
ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", SAID), (1, 1, "assistant", SAID), (1, 2, "user", None), (1, 3, "assistant", "\\"),
    (2, 0, None, "a: b"), (2, None, "odd: role\n</turn>", "é🤗\n### "), (None, 0, "assistant", "<|image:0|> \\### <"), (None, 0, "user", ""),
    (3, 0, "assistant", "<"), (3, 1, "assistant", "/turn>"), (4, 0, "Assistant", "#####\\\\"),
]


def turns(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], TURNS).repartition(3)


def test_turns_come_back(spark):
    found = chat.format_turns(turns(spark)).collect()
    back = [chat.parsed(r.formatted) for r in found]
    assert sorted(back) == sorted((r or "", t or "") for _, _, r, t in ROWS)
    for r, (role, text) in zip(found, back, strict=True):
        masked = chat.unescaped(r.formatted[r.loss_start : r.loss_end])
        assert masked == (text if role == "assistant" else "")
        # Only the template's own marks are not escaped.
        bare = chat.ESCAPED.sub("", r.formatted)
        assert bare.count("###") == 1 and bare.count("</turn>") == 1


def test_a_conversation_splits_back_into_its_turns(spark):
    found = chat.format_turns(turns(spark)).collect()
    whole = "".join(r.formatted for r in found)
    assert [m[0] for m in chat.TURN.finditer(whole)] == [r.formatted for r in found]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.text("au:\\ \n#</trn>|é", max_size=12), st.text("\\#</turn>| ab", max_size=25)), min_size=1, max_size=30))
def test_any_marks(spark, said):
    rows = [(1, k, role, text, "", "") for k, (role, text) in enumerate(said)]
    found = chat.format_turns(spark.createDataFrame(rows, TURNS)).orderBy("turn").collect()
    assert [chat.parsed(r.formatted) for r in found] == said


def test_digests(spark):
    found = {r.conv_id: r for r in chat.read_back(chat.format_turns(turns(spark))).collect()}
    assert set(found) == {1, 2, 3, 4, None}
    for key in (1, 3, 4):
        own = [(r or "", t or "") for i, _, r, t in ROWS if i == key]
        learnt = "".join(t for r, t in own if r == "assistant")
        row = found[key]
        assert row.n_turns == len(own) and row.loss_chars == len(learnt)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
    formatted = chat.format_turns(turns(spark)).collect()
    assert found[1].formatted_chars == sum(len(r.formatted) for r in formatted if r.conv_id == 1)
    # A null turn comes first.
    first = hashlib.sha256("odd: role\n</turn>\né🤗\n### \n\na: b\n".encode()).hexdigest()
    assert found[2].turns_sha256 == first


def test_parts(spark):
    rows = [(
        1, 0, "user",
        [("text", "see <|", None, None, None, None, None), ("image", None, "s3://a.png", 57, 28, None, None), None,
         ("audio", None, "b.wav", None, None, 2.5, None), ("text", " and ", None, None, None, None, None),
         ("document", None, None, None, None, None, 3), ("video", "?", "c", None, None, None, None)],
    ), (1, 1, "assistant", None)]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    first, second = chat.format_turns(df, parts_column="parts").orderBy("turn").collect()
    assert first.formatted == "### user: see \\<|<|image:0|><|audio:1|> and <|document:2|>?</turn>\n"
    assert [tuple(a) for a in first.attachments] == [
        (0, "image", "s3://a.png", 3 * 1), (1, "audio", "b.wav", 63), (2, "document", None, 3 * chat.TOKENS_PER_PAGE)
    ]
    assert second.formatted == "### assistant: </turn>\n" and second.loss_start == second.loss_end


def test_a_text_goes_through_the_visitor_as_a_part(spark, monkeypatch):
    seen = []
    flattened = chat._flattened
    monkeypatch.setattr(chat, "_flattened", lambda parts: seen.append(parts) or flattened(parts))
    formatted = chat.format_turns(turns(spark))
    (parts,) = turns(spark, ROWS[:1]).select(seen[0].alias("parts")).first()
    assert [(p.kind, p.text) for p in parts] == [("text", "hi")]
    assert all(r.attachments == [] for r in formatted.collect())


def test_what_is_no_turn_is_an_error():
    with pytest.raises(ValueError):
        chat.parsed("### user: a</turn> b</turn>\n")


def test_empty(spark):
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], TURNS))).count() == 0
