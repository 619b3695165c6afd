"""Chat windows: exact round trip, budgets, history and masks."""

import hashlib
from collections import defaultdict

import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lodeworks.llm.chat import Template, digests, windows
from lodeworks.llm.queries import op8_chat_windows

PATH = public_tokenizers.path("byte_bpe_50k.json")
TURNS = "conv_id long, turn long, role string, text string"


@given(st.text("<s>/[INST] \\-ok", max_size=30), st.text("<s[INST]\n\\-", max_size=8))
def test_escape_can_be_undone(text, role):
    template = Template()
    escaped = template.escape(text)
    assert template.unescape(escaped) == text
    assert not any(c in escaped for c in template.controls)
    whole, start, end = template.turn(role, text)
    assert [x[:2] for x in template.read(whole * 2)] == [(role, text)] * 2
    assert template.unescape(whole[start:end]) == text


def expected(rows):
    by_conv = defaultdict(list)
    for conv_id, turn, role, text in rows:
        by_conv[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv_id, turns in by_conv.items():
        whole, loss = hashlib.sha256(), ""
        for _, _, role, text in sorted(turns):
            whole.update(f"{role}\n{text}\n".encode())
            loss += text if role == "assistant" else ""
        out[conv_id] = (len(turns), whole.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_round_trip_of_all_conversations(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    probe = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", probe), (-1, 1, "assistant", probe)]
    found = {r[0]: tuple(r[1:5]) for r in op8_chat_windows(spark, sf).collect()}
    assert found == expected(rows)


@pytest.mark.parametrize(("budget", "history"), [(60, 20), (200, 0), (30, 1000)])
def test_budget_history_and_mask(spark, sf, budget, history):
    turns = spark.read.parquet(f"{sf}/conversations.parquet").where("conv_id < 30")
    extra = spark.createDataFrame([(77, k, "system" if k == 0 else "user" if k % 2 else "assistant", f"turn {k} " * 3) for k in range(40)], TURNS)
    turns = turns.select("conv_id", "turn", "role", "text").union(extra)
    tokenizer, template = Tokenizer.from_file(PATH), Template()
    formed = windows(turns, PATH, budget, history)
    by_conv = defaultdict(list)
    for r in formed.orderBy("conv_id", "window").collect():
        read = template.read(r.text)
        new, old = read[-r.n_new :], read[: -r.n_new]
        tokens = [len(tokenizer.encode(template.turn(x[0], x[1])[0]).ids) for x in read]
        if r.n_new > 1:
            assert sum(tokens) <= budget
        if r.window and by_conv[r.conv_id][0][0] == "system":
            assert old[0][:2] == by_conv[r.conv_id][0]
            old, tokens = old[1:], tokens[1:]
        assert sum(tokens[: len(old)]) <= history
        assert [x[:2] for x in old] == by_conv[r.conv_id][len(by_conv[r.conv_id]) - len(old) :]
        assert [(s.start, s.end) for s in r.loss] == [x[2:] for x in new if x[0] == "assistant"]
        by_conv[r.conv_id] += [x[:2] for x in new]
    rows = [tuple(r) for r in turns.collect()]
    found = {r[0]: tuple(r[1:5]) for r in digests(formed).collect()}
    assert found == expected(rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "a"), (None, 1, "assistant", None), (1, None, None, None), (1, 0, "assistant", "<s>"), (1, 0, "assistant", "<s>"),
        (2, 0, "system", ""), (2, 1, "assistant", "x " * 5000), (2, 2, "user", "\\-<s>[INST]"), (0, 0, "", ""),
    ]
    turns = spark.createDataFrame([(*r, "y", 1) for r in rows], TURNS + ", window string, loss int")
    found = {r[0]: tuple(r[1:5]) for r in digests(windows(turns, PATH)).collect()}
    assert found == expected(rows)
    assert digests(windows(turns.limit(0), PATH)).collect() == []
