import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corvid.llm import chat_format as cf

TEXTS = st.text(alphabet=st.sampled_from(list("\\#</turn>: \nassistantA###é🎉")), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TEXTS, TEXTS), max_size=5))
def test_rendered_turns_parse_back(turns):
    assert cf.parse_turns("".join(cf.render_turn(r, t) for r, t in turns)) == turns


@pytest.mark.parametrize("bad", ["x", "### user\n", "### a:\nx", "### a:\n</turn>", "### a:\n#</turn>\n"])
def test_other_strings_do_not_parse(bad):
    with pytest.raises(ValueError):
        cf.parse_turns(bad)


def test_fold_applies_deltas_edits_and_regenerations(spark):
    events = [
        (1, 3, 0, "start", "assistant", None), (1, 4, 0, "delta", None, "bad"), (1, 5, 0, "regenerate", None, None),
        (1, 6, 0, "delta", None, "go"), (1, 7, 0, "delta", None, "od"), (1, 0, 0, "start", "user", "h"),
        (1, 1, 0, "delta", None, "i"), (1, 2, 0, "edit", None, "hello"), (2, 1, 0, "delta", None, "orphan"),
        (2, 2, 0, "start", None, None),
    ]
    log = cf.sorted_log(spark.createDataFrame(events, cf.EVENTS))
    got = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in cf.fold(log).collect()]
    assert sorted(got) == [(1, 0, "user", "hello"), (1, 1, "assistant", "good"), (2, 0, "", "orphan"), (2, 1, "", "")]


def expected(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    every = "".join(f"{r}\n{t}\n" for r, t in turns)
    return (
        len(turns), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(),
        sum(len(cf.render_turn(r, t)) for r, t in turns),
    )


def test_table_of_messages(spark):
    rows = [
        (1, 2, "assistant", "\\### Assistant: </turn> ok"), (1, 0, "user", None), (1, 1, None, "x" * 300_000),
        (2, 5, "assistant", "a"), (2, 5, "assistant", "a"), (None, 0, "user", "n"), (3, None, "user", "first"),
        (3, -1, "assistant", "second"),
    ]
    df = spark.createDataFrame(
        [(*r, "e", 1) for r in rows], "conv_id long, turn long, role string, text string, event string, sub long"
    )
    got = {r["conv_id"]: tuple(r)[1:] for r in cf.read_back(cf.format_log(cf.as_events(df))).collect()}
    assert got == {
        1: expected([("user", ""), ("", "x" * 300_000), ("assistant", "\\### Assistant: </turn> ok")]),
        2: expected([("assistant", "a"), ("assistant", "a")]),
        None: expected([("user", "n")]),
        3: expected([("user", "first"), ("assistant", "second")]),
    }
    assert cf.read_back(cf.format_log(cf.as_events(df.limit(0)))).count() == 0
