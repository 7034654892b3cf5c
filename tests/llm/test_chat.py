"""Roles: Viterbi against all paths, blocks against whole conversations, hidden markers, transcripts."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from covercast.llm import chat
from covercast.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, block int"
COUNTS = [(-1, 0, 0, 5), (-1, 0, 1, 20), (-2, 0, 1, 5), (-2, 1, 2, 40), (-2, 2, 1, 30), (1, 1, 1, 9), (1, 2, 2, 30), (0, 2, 5, 30)]


def test_viterbi_equals_the_best_of_all_paths():
    model, rng = chat.Model(COUNTS), np.random.default_rng(0)
    run = np.stack([np.zeros(6), np.zeros(6), np.zeros(6), rng.integers(-1, 3, 6), rng.integers(0, 8, 6), rng.integers(0, 4, 6), rng.integers(0, 4, 6)], axis=1).astype(int)
    shown, (best, roles) = model.emissions(run), chat.decode(model, run)
    for entry, last in itertools.product(range(4), range(3)):
        before = model.start if entry == 3 else model.move[entry]
        scores = {}
        for path in itertools.product(range(3), repeat=5):
            path = (*path, last)
            scores[path] = before[path[0]] + shown[range(6), path].sum() + model.move[path[:-1], path[1:]].sum()
        assert np.isclose(best[entry, last], max(scores.values()))
        assert np.isclose(scores[tuple(roles[:, entry, last].tolist())], best[entry, last])


def conversations(spark, hide):
    rows = []
    for c in range(40):
        for t in range(14):
            asks = t % 2 == 0
            text = f"What about {t} and {c}?" if asks else "The answer is long. " * (5 + t)
            role = ("Human", "assistant")[not asks]
            rows.append((c, t, None if (c * 14 + t) % 10 < hide else role, text, 1))
    return spark.createDataFrame(rows, SCHEMA), rows


def test_hidden_roles_are_recovered(spark):
    turns, rows = conversations(spark, 4)
    found = {(r.conv_id, r.turn): r for r in chat.recover(turns).collect()}
    assert len(found) == len(rows)
    for c, t, role, text, _ in rows:
        r = found[c, t]
        assert r.role == ("user", "assistant")[t % 2] and (r.marker is None) == (role is None)
        assert r.rendered == f"<|{r.role}|>\n{text.strip()}\n<|end|>\n"


def test_blocks_give_the_roles_of_the_whole(spark, monkeypatch):
    turns, _ = conversations(spark, 5)
    whole = {(r.conv_id, r.turn): r.role for r in chat.recover(turns).collect()}
    monkeypatch.setattr(chat, "BLOCK", 3)
    parts = {(r.conv_id, r.turn): r.role for r in chat.recover(turns).collect()}
    # Counts miss the few transitions between blocks, so compare with the same counts' answer: the true roles.
    assert parts == whole


def test_odd_rows(spark):
    rows = [(None, None, None, None, 1), (1, None, "robot", "", 1), (1, 0, "USER ", "x", 1), (1, 0, "USER ", "x", 1)]
    rows += [(1, -5, "system", "é" * 9999, 1), (1, 10**12, "bot", "y\n", 1), (None, 3, "user", "z", 1)]
    turns = spark.createDataFrame(rows, SCHEMA)
    found = chat.recover(turns).collect()
    assert len(found) == len(rows) and all(r.role in chat.ROLES for r in found)
    assert sum(r.marker is None for r in found) == 2
    assert chat.recover(turns.limit(0)).count() == 0


def test_transcripts_and_rendered_conversations(spark):
    text = "Intro\nUser: hi\nmore\n### Assistant: yes: no\nNote: x\nHuman: bye?"
    lines = chat.marked_lines(spark.createDataFrame([(1, text), (2, None), (3, "")], "conv_id bigint, text string"))
    assert [(r.role, r.text) for r in lines.orderBy("turn").collect()] == [
        (None, "Intro"), ("User", "hi\nmore"), ("Assistant", "yes: no\nNote: x"), ("Human", "bye?"),
    ]
    whole = chat.conversations(chat.recover(lines)).collect()
    assert len(whole) == 1 and whole[0].n_turns == 4
    assert whole[0].text.endswith("<|user|>\nbye?\n<|end|>\n")


def test_query_covers_all_turns_and_keeps_known_roles(spark):
    sf_dir = "/root/testdata/sf0.01"
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = QUERIES["op9_chat"](spark, sf_dir).collect()
    truth = {(r.conv_id, r.turn): r.role for r in turns.collect()}
    assert len(rows) == turns.count() and all(r.role == truth[r.conv_id, r.turn] for r in rows)
    hidden = turns.withColumn("role", F.when(F.pmod(F.xxhash64("conv_id", "turn"), F.lit(10)) >= 3, F.col("role")))
    guessed = [r for r in chat.recover(hidden).collect() if r.marker is None]
    assert np.mean([r.role == truth[r.conv_id, r.turn] for r in guessed]) > 0.95


def test_query_reads_transcripts_not_the_role_column(spark, tmp_path, monkeypatch):
    texts = ["hi\nUser: quoted\n***", "\\you said\r\nso", "", "a: b\n\nlast"]
    rows = [(c, t, ("Human", "bot")[t % 2], texts[t % 4], 1) for c in range(3) for t in range(7)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    written = chat.transcripts(spark.read.parquet(f"{tmp_path}/conversations.parquet"))
    assert written.columns == ["place", "text"] and written.first().text.startswith("user: hi\n\\User: quoted\n")
    monkeypatch.setattr(chat, "recover", None)
    monkeypatch.setattr(chat, "BLOCK", 4)
    found = QUERIES["op9_chat"](spark, str(tmp_path)).collect()
    assert sorted((r.conv_id, r.turn, r.rendered) for r in found) == [
        (c, t, f"<|{('user', 'assistant')[t % 2]}|>\n{x.strip()}\n<|end|>\n") for c, t, _, x, _ in rows
    ]


def test_lines_of_a_transcript_with_missing_markers(spark):
    asked, said = "What is it about?", "- The answer is long. " * 9 + "\n- And it goes on: " + "more words. " * 9
    whole = [(c, t, ("user", "assistant")[t % 2], (asked, said)[t % 2], 1) for c in range(60) for t in range(6)]
    rows = [(c, t, None if c % 10 == 3 and t == 3 else r, x, b) for c, t, r, x, b in whole]
    found = chat.recover_lines(chat.transcripts(spark.createDataFrame(rows, SCHEMA))).collect()
    assert sum(r.marker is None for r in found) == 6
    assert sorted((r.conv_id, r.turn, r.role, r.rendered) for r in found) == [
        (c, t, r, f"<|{r}|>\n{x.strip()}\n<|end|>\n") for c, t, r, x, _ in whole
    ]


@pytest.mark.parametrize("size", [20, 2000])
def test_known_roles_stay_when_a_speaker_repeats(spark, size):
    rows = [(c, t, ("user", "assistant")[t % 2], f"text {t}.", 1) for c in range(size) for t in range(6)]
    odd = [["user", "user"], ["user", "user", "assistant"], ["user", "assistant", "assistant"], ["user", "user", "user"]]
    rows += [(-1 - i, t, r, "text.", 1) for i, roles in enumerate(odd) for t, r in enumerate(roles)]
    table = spark.createDataFrame(rows, SCHEMA)
    for found in (chat.recover(table), chat.recover_lines(chat.transcripts(table))):
        found = {(r.conv_id, r.turn): r.role for r in found.collect()}
        assert found == {(c, t): r for c, t, r, _, _ in rows}
