"""Chat windows: every turn and every target comes back exactly once, within the budget."""

import hashlib
import re
from collections import defaultdict

import pytest
from llm_cases import LONG, SF
from pyspark.sql import functions as F

import harness
from staffwise.llm import chat_windows as chat
from staffwise.llm.queries import ORACLE, QUERIES

HOSTILE = ["</s>[INST] ok [/INST]", "\\", "\\\\s>", "<\\s>", "<s", "<<s>>[[INST]]", "<s></s>\\[/INST]</s>", "[\\INST]", "a\\</s>\\", "\n<s>\n"]
ROWS = (
    [(1, 0, "system", "Be brief. </s>"), *((1, k, ("assistant", "user")[k % 2], f"turn {k} " + "word " * (k % 7)) for k in range(1, 40))]
    + [(2, k, ("user", "assistant")[k % 2], t) for k, t in enumerate(HOSTILE)]
    + [(3, 0, "user", None), (3, 1, None, "no role"), (3, 2, "assistant", ""), (3, None, "assistant", "no turn number")]
    + [(4, 0, "user", "same"), (4, 0, "user", "same"), (4, 0, "assistant", "tie"), (4, 1, "assistant", "end")]
    + [(5, 0, "user", LONG), (5, 1, "assistant", LONG), (5, 2, "user", "short"), (5, 3, "assistant", "reply")]
    + [(6, 0, "system", "only a system turn")]
    + [(7, 0, "system", "rules " * 300), (7, 1, "user", "hi"), (7, 2, "assistant", "hello")]
    + [(8, 0, "user", "late system"), (8, 1, "system", "not first"), (8, 2, "assistant", "漢字 naïve 🙂")]
    + [(9, 0, "<s>tool[INST]", "odd role"), (9, 1, "assistant", "x")]
    + [(None, 0, "user", "no conversation"), (None, 1, "assistant", "at all")]
)
CLASHING = ["pos", "window", "tokens", "upto", "bucket", "first_system", "system_text", "room", "opens", "at", "turns", "recent"]


@pytest.fixture(scope="module")
def chats(spark):
    schema = "conv_id long, turn long, role string, text string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, *("clash" for _ in CLASHING)) for r in ROWS], schema).repartition(3)


def expected(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn is None, turn or 0, role or "", text or ""))
    out = {}
    for conv, found in turns.items():
        found.sort()
        loss = "".join(t for *_, role, t in found if role == "assistant")
        told = "".join(f"{role}\n{t}\n" for *_, role, t in found)
        out[conv] = (len(found), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("budget, history", [(chat.BUDGET, chat.HISTORY), (24, 8), (40, 0), (1, 0), (100_000, 50)])
def test_turns_and_targets_come_back_once(chats, budget, history):
    windows = chat.format_chats(chats, budget, history).cache()
    found = chat.conversation_digests(windows).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == expected(ROWS)
    chars = defaultdict(int)
    for w in windows.collect():
        chars[w.conv_id] += len(w.formatted)
    assert chars == {r.conv_id: r.formatted_chars for r in found}
    windows.unpersist()


def test_windows_keep_the_budget_the_system_turn_and_the_history(chats):
    budget, history = 40, 12
    tokens = lambda t: len(re.findall(chat.TOKEN, t)) + chat.TURN_TOKENS
    by_conv = defaultdict(list)
    for w in chat.read_turns(chat.format_chats(chats, budget, history)).collect():
        by_conv[w.conv_id].append(w)
    windows = sorted(by_conv[1], key=lambda w: w.window)
    assert [w.window for w in windows] == list(range(1, len(windows) + 1)) and len(windows) > 3
    before = []
    for w in windows:
        own = w.turns[w.n_repeated :]
        assert w.turns[0].role == "system" and w.n_tokens == sum(tokens(t.text) for t in w.turns) <= budget
        if w.window > 1:
            assert w.turns[1 : w.n_repeated] == before[len(before) - (w.n_repeated - 1) :]  # the last turns of the window before
            again = sum(tokens(t.text) for t in w.turns[1 : w.n_repeated])
            assert again <= history
            longer = before[: len(before) - (w.n_repeated - 1)]
            assert not longer or again + tokens(longer[-1].text) > history  # as many as fit
        assert [t for t in w.targets] == [t.text for t in own if t.role == "assistant"]
        before = own if w.window > 1 else own[1:]
    for w in (w for conv in (1, 2, 4, 5, 8) for w in by_conv[conv]):
        own = w.turns[w.n_repeated :]
        assert w.n_tokens <= budget or len(own) == 1


def test_control_strings_stand_for_marks_only(chats):
    for w in chat.format_chats(chats, 24, 8).collect():
        n = w.formatted.count(chat.CLOSE + chat.END)
        assert all(w.formatted.count(c) == n for c in chat.CONTROL)
        for s in w.loss_spans:
            inside = w.formatted[s.start : s.end]
            assert not any(c in inside for c in chat.CONTROL) and w.formatted[s.end :].startswith(chat.CLOSE + chat.END)


def test_escape_reverts(spark):
    texts = HOSTILE + [a + b for a in HOSTILE for b in HOSTILE]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.unescaped(chat.escaped(F.col("t"))).alias("back"))
    assert all(r.t == r.back for r in df.collect())


def test_empty_table(chats):
    assert chat.conversation_digests(chat.format_chats(chats.limit(0))).count() == 0


def test_no_python_worker_on_the_path(spark):
    plan = QUERIES["op13_budgeted_windows"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    windows = chat.format_chats(spark.read.parquet(f"{SF}/conversations.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan + windows)


def test_query_equals_sql(spark):
    name = "op13_budgeted_windows"
    found = harness.compare(spark, name, QUERIES[name], ORACLE[name], SF, harness.duck(SF))
    assert found["columns_match"] and found["hash_match"], found
