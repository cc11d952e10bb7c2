import hashlib
from collections import defaultdict

from hypothesis import given
from hypothesis import strategies as st

from deedflow.llm.chat_format import CHAT, TRICK, Template, chat_digests, format_turns

CONTROL = [x for a, b, _ in CHAT.roles.values() for x in (a, b)] + list(CHAT.other)
text = st.lists(st.one_of(st.sampled_from([*CONTROL, "\\", "<", "[", "\n", "INST] "]), st.text(max_size=4)), max_size=8).map("".join)


@given(text)
def test_escape_is_reversible_and_leaves_no_control_string(x):
    out = CHAT.escape(x)
    assert CHAT.unescape(out) == x
    assert not any(c in out for c in CONTROL)


@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", "", "tool"]), text), text), max_size=6))
def test_round_trip_through_the_template(turns):
    out = "".join(t for r, x in turns for t, _ in CHAT.segments(r, x))
    assert list(CHAT.parse(out)) == [(r, x, r == "assistant") for r, x in turns]


def test_texts_that_end_in_a_part_of_a_control_string():
    other = Template(roles={"a": ("<a>", "xyx", True)}, other=("<r>", "-=-", "zz"))
    for template in (CHAT, other):
        control = [x for a, b, _ in template.roles.values() for x in (a, b)] + list(template.other)
        ends = sorted({c[:n] for c in control for n in range(1, len(c) + 1)})
        turns = [(r, t + e) for r in [*template.roles, "tool", *ends] for e in ends for t in ("", "text ", "\\")]
        out = "".join(t for r, x in turns for t, _ in template.segments(r, x))
        assert [(r, x) for r, x, _ in template.parse(out)] == turns


ROWS = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "assistant", None), (2, 0, None, "z"), (None, 0, "user", "x"), (3, None, "user", TRICK), (3, 2, "assistant", TRICK), (3, 2, "assistant", TRICK), (4, 0, "system", "s" * 100_000), (4, 1, "user", ""), (4, 2, "assistant", "é\U0001f600")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 7) for r in rows], "conv_id long, turn long, role string, text string, segments string, valid int")


def test_digests_against_brute_force(spark):
    got = {r.conv_id: r for r in chat_digests(frame(spark, ROWS)).collect()}
    by = defaultdict(list)
    for c, t, r, x in ROWS:
        by[c].append((-1 if t is None else t, r or "", x or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].formatted_chars == sum(len(t) for _, r, x in turns for t, _ in CHAT.segments(r, x))
    assert {c: got[c].valid for c in got} == {1: True, 2: False, None: False, 3: False, 4: True}
    assert got[3].violation == "assistant after answered"


def test_segments_and_empty_table(spark):
    rows = format_turns(frame(spark, ROWS)).where("conv_id = 1").orderBy("turn").collect()
    assert [[(s.text, s.loss) for s in r.segments] for r in rows] == [[("[INST] ", False), ("a", False), (" [/INST]", False)], [("<s>", False), ("b", True), ("</s>", False)]]
    assert chat_digests(frame(spark, [])).collect() == [] == format_turns(frame(spark, [])).collect()
