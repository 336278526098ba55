"""Chat formatting: reversible escapes, spans from black-box rendering, rewritten history."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from riskbook.llm import chat_format as c
from riskbook.llm.common import read_table
from riskbook.llm.queries import QUERIES

PIECES = ["\\", "</s>", "<s>", "[INST]", "[/INST]", " [/INST]\n", "[ANS", "] ", '[ROLE "x"] ', " </s>\n", "a", "\n", " ", "é"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=6).map("".join)
TURNS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", None, "x]\n</s>"]), TEXT), max_size=30)


@settings(max_examples=300, deadline=None)
@given(TURNS)
def test_round_trip_and_loss(turns):
    found = c.locate(turns, c.render)
    text = found["formatted"]
    assert text == c.render(turns) and c.parse(text) == turns and not found["rewrites"]
    prefixes = [len(c.render(turns[:i])) for i in range(len(turns) + 1)]
    assert found["starts"] == prefixes[:-1] and found["ends"] == prefixes[1:]
    learnt = [c.unescape(text[a:b]) for a, b in found["loss"]]
    assert learnt == [t for role, t in turns if role == "assistant"]


def test_context_dependent_template_falls_back():
    numbered = lambda turns: "".join(f"<{i}>{role}:{text};" for i, (role, text) in enumerate(turns))
    turns = [("user", "q"), ("assistant", "a")] * 40
    found = c.locate(turns, numbered)
    assert found["formatted"] == numbered(turns) and not found["rewrites"]
    assert [found["formatted"][a:b] for a, b in found["loss"]] == ["a"] * 40


def test_rewritten_history_is_reported():
    def strips(turns):
        return "".join(
            f"{role}:{'' if role == 'assistant' and i < len(turns) - 1 else text};" for i, (role, text) in enumerate(turns)
        )

    found = c.locate([("user", "q"), ("assistant", "thought"), ("user", "r")], strips)
    assert found["rewrites"] == [2] and found["loss"] == [] and found["starts"] == [None] * 3


def test_rewrite_undone_a_turn_later_is_reported():
    def reminds(turns):
        parts = [f"{role}:{text};" for role, text in turns]
        if turns and turns[-1][0] == "tool":
            parts.insert(len(parts) - 1, "".join(f"<{text}>" for role, text in turns if role == "system"))
        return "".join(parts)

    roles = ["system", *["user", "assistant"] * 8][:16]
    roles[10] = "tool"
    turns = [(role, f"t{i}") for i, role in enumerate(roles)]
    found = c.locate(turns, reminds)
    whole = [reminds(turns[:i]) for i in range(17)]
    assert found["formatted"] == whole[16]
    assert found["rewrites"] == [i for i in range(16) if not whole[i + 1].startswith(whole[i])] == [11]
    assert found["starts"][:12] == [None] * 12 and found["ends"][15] == len(whole[16])


@settings(max_examples=100, deadline=None)
@given(TURNS)
def test_declared_template_gives_the_same_by_segments(turns):
    assert c.locate(turns, c.render, append_only=True) == c.locate(turns, c.render)


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _expected(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, role, text or ""))
    found = {}
    for conv, turns in groups.items():
        turns.sort()
        told = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        learnt = "".join(text for _, role, text in turns if role == "assistant")
        found[conv] = (len(turns), _sha(told), len(learnt), _sha(learnt))
    return found


def test_query_on_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in QUERIES["op4_chat_formatting"](spark, sf_dir).collect()}
    assert found == _expected(rows)


def test_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string, id int"
    rows = [
        (None, 0, "user", "a", "x", 1), (None, 1, "user", "b", "x", 1), (1, 0, None, None, "x", 1),
        (1, 0, None, None, "x", 1), (2, None, "assistant", "z" * 100_000, "x", 1),
    ]
    found = c.read_back(c.format_chats(spark.createDataFrame(rows, schema))).collect()
    assert sorted((r.conv_id or 0, r.n_turns, r.loss_chars) for r in found) == [(0, 1, 0), (0, 1, 0), (1, 2, 0), (2, 1, 100_000)]
    assert c.read_back(c.format_chats(spark.createDataFrame([], schema))).collect() == []
