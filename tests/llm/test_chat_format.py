import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sedimenta.llm import chat_format as chat
from sedimenta.llm.chat_format import CONTROLS, INSTRUCT, MarkedTemplate, Turn

PIECES = st.sampled_from([*CONTROLS, "\\", "<", "[", "s>", "/INST]", " ", "\n", "é", "\U0001f600", "user", "assistant", "ok"])
TEXTS = st.lists(PIECES, max_size=8).map("".join)
TURNS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system"]) | TEXTS, TEXTS), max_size=6)


@given(TEXTS)
@settings(max_examples=300, deadline=None)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    escaped = INSTRUCT.escape(text)
    assert INSTRUCT.unescape(escaped) == text
    assert not any(c in escaped for c in CONTROLS)


@given(TURNS)
@settings(max_examples=300, deadline=None)
def test_outputs_read_back_and_spans_hold_the_texts(raw):
    turns = [Turn(*t) for t in raw]
    made = chat.locate([INSTRUCT.escaped(t) for t in turns], INSTRUCT.render)
    assert INSTRUCT.read(made.text) == turns and made.rewritten_at == -1
    end = len(INSTRUCT.opening)
    for turn, span in zip(turns, made.spans, strict=True):
        assert span.start == end and INSTRUCT.unescape(made.text[span.text_start:span.text_end]) == turn.text
        end = span.end
    assert end == len(made.text)


def last_thought_only(turns):
    """Drops the thoughts of all turns but the last one, as some templates do."""
    return "".join(f"{t.role}: {t.text if i == len(turns) - 1 else t.text.split('</think>')[-1]}\n" for i, t in enumerate(turns))


def test_a_template_that_rewrites_history_is_found():
    turns = [Turn("user", "hi"), Turn("assistant", "<think>a</think>yes"), Turn("user", "so"), Turn("assistant", "<think>b</think>no")]
    made = chat.locate(turns, last_thought_only)
    assert made.rewritten_at == 2
    held = [made.text[s.text_start:s.text_end] if s.text_start >= 0 else None for s in made.spans]
    # The text of the second turn is not in the output as it was put in.
    assert held == ["hi", None, "so", "<think>b</think>no"]


def test_a_template_that_drops_or_strips_turns():
    dropping = lambda turns: "".join(f"[{t.text.strip()}]" for t in turns if t.role != "system")
    made = chat.locate([Turn("system", "x"), Turn("user", " a "), Turn("user", "]["), Turn("user", "")], dropping)
    assert made.text == "[a][][][]" and made.rewritten_at == -1
    assert [(s.start, s.end) for s in made.spans] == [(0, 0), (0, 3), (3, 7), (7, 9)]
    assert [s.text_start for s in made.spans] == [-1, -1, 4, 8]


def test_a_trailer_after_every_prefix_counts_as_rewriting_but_texts_are_found():
    made = chat.locate([Turn("user", "a"), Turn("assistant", "bb")], lambda turns: "".join(f"<{t.text}>" for t in turns) + "|")
    assert made.rewritten_at == 0 and made.text == "<a><bb>|"
    assert [made.text[s.text_start:s.text_end] for s in made.spans] == ["a", "bb"]


def test_marks_must_be_readable():
    with pytest.raises(ValueError):
        MarkedTemplate(opening="<BOS>")
    with pytest.raises(ValueError):
        MarkedTemplate(controls=(*CONTROLS, "<<x>"))
    with pytest.raises(ValueError):
        MarkedTemplate(roles={"a": ("<s>", "</s>"), "b": ("<s>", "<|end|>")})


def test_conversations(spark):
    rng = random.Random(5)
    said = ["</s>", "[INST] ok [/INST]", "", None, "x" * 1_000_000, "é\n", "<\\s>", "same"]
    rows = [(i % 7, rng.choice([None, j, j]), rng.choice(["user", "assistant", "system", None, "[ROLE]"]), said[j % 8])
            for i in range(14) for j in range(8)] + [(None, 0, "user", "lost"), (99, None, None, None)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted int")
    made = chat.format_conversations(frame, INSTRUCT.render, INSTRUCT.escaped)
    got = {r.conv_id: r for r in chat.read_back(made, INSTRUCT).collect()}
    assert set(got) == {*range(7), None, 99}
    for conv in got:
        turns = sorted(((t is not None, t or 0), r or "", x or "") for c, t, r, x in rows if c == conv)
        learned = "".join(x for _, r, x in turns if r == "assistant")
        sha = [hashlib.sha256(s.encode()).hexdigest() for s in ("".join(f"{r}\n{x}\n" for _, r, x in turns), learned)]
        row = got[conv]
        assert (row.n_turns, row.turns_sha256, row.loss_chars, row.loss_sha256) == (len(turns), sha[0], len(learned), sha[1])
        assert row.formatted_chars == len(INSTRUCT.render([INSTRUCT.escaped(Turn(r, x)) for _, r, x in turns]))
    assert made.where("rewritten_at >= 0").count() == 0
    assert chat.read_back(chat.format_conversations(frame.limit(0), INSTRUCT.render), INSTRUCT).collect() == []
