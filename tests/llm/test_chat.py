import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from sluicegate.llm import chat
from sluicegate.llm.queries import CONTROL_TEXT

PIECES = st.lists(st.sampled_from(["\\", "### ", "Assistant: ", "User", "=", "</turn>", "\n", "x", " "]), max_size=12)


@settings(max_examples=600, deadline=None)
@given(PIECES.map("".join), st.one_of(st.sampled_from(["user", "assistant", "system"]), PIECES.map("".join)))
def test_turns_come_back(text, role):
    rendered = chat.render(role, text)
    assert [t[:2] for t in chat.parse(rendered + chat.render("user", "next"))] == [(role, text), ("user", "next")]


def test_plain_text_stays_plain():
    assert chat.render("user", "a \\ b") == "### User: a \\ b\n</turn>\n"
    assert chat.render("assistant", CONTROL_TEXT) == "### Assistant: \\\\### Assistant: \\</turn> ok\n</turn>\n"
    assert len(chat.render("user", "</turn>" * 20_000)) == 10 + 8 * 20_000 + 9


def test_digests(spark):
    rows = [
        (1, 1, "assistant", "Hi </turn>"), (1, 0, "user", "Hé"), (1, 2, None, None), (2, None, "tool: x", "### User: a"),
        (None, 0, "assistant", "z"), (2, None, "tool: x", "### User: a"),
    ]
    rows = [(*r, "extra") for r in rows]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns string")
    turns = chat.format_turns(frame)
    got = {r.conv_id: r for r in chat.digest_conversations(turns).collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert got[1].turns_sha256 == sha("user\nHé\nassistant\nHi </turn>\n\n\n") and got[1].n_turns == 3
    assert (got[1].loss_chars, got[1].loss_sha256) == (10, sha("Hi </turn>"))
    assert got[2].n_turns == 2 and got[2].loss_sha256 == sha("")
    assert got[None].loss_chars == 1
    assert got[1].formatted_chars == sum(len(r.rendered) for r in turns.where("conv_id = 1").collect())
    assert chat.digest_conversations(chat.format_turns(frame.limit(0))).collect() == []
