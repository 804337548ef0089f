"""Viterbi against all state sequences, markers, rendering, held-out accuracy."""

import itertools
import random

import numpy as np
from kpiforge.llm import chat_hmm as H
from kpiforge.llm import queries as Q
from kpiforge.llm.queries import op6_chat_hmm
from pyspark.sql import functions as F


def chat(rnd, bare=0.2):
    turns = []
    for k in range(rnd.randint(2, 7)):
        role = "user" if k % 2 == 0 else "assistant"
        text = "\n".join(" ".join(["word"] * rnd.randint(2, 6) if role == "user" else ["Longer"] * rnd.randint(30, 90))
                         for _ in range(1 if role == "user" else 2)) + ("?" if role == "user" else ".")
        turns.append((role, ("" if rnd.random() < bare else f"{role.title()}: ") + text))
    return turns


MODEL = H.learn([chat(random.Random(k)) for k in range(200)])


def test_viterbi_against_all_sequences():
    rnd = random.Random(1)
    for _ in range(20):
        seen = [tuple(rnd.randrange(n) for n in H.SIZES) for _ in range(rnd.randint(1, 5))]

        def value(states):
            v = MODEL.start[states[0]] + sum(MODEL.step[a, b] for a, b in itertools.pairwise(states))
            return v + sum(t[s, o[k]] for s, o in zip(states, seen, strict=True) for k, t in enumerate(MODEL.emit))

        best = max(value(p) for p in itertools.product(range(len(H.STATES)), repeat=len(seen)))
        assert np.isclose(value(H.viterbi(MODEL, seen)), best)
    assert H.viterbi(MODEL, []) == []


def test_markers():
    kinds = {"User: hi": (2, "hi"), "**Assistant:** hi": (3, "hi"), "[human] hi": (2, "hi"), "### System": (1, ""), "<|ai|> hi": (3, "hi"),
             "Q: why": (2, "why"), "usernames: x": (0, "usernames: x"), "A man: x": (0, "A man: x"), "me too": (0, "me too")}
    for line, (kind, rest) in kinds.items():
        assert (H.observe(line)[0][0], H.observe(line)[1]) == (kind, rest)


def test_turns_without_a_marker_are_found():
    rnd, right, total = random.Random(7), 0, 0
    for _ in range(100):
        turns = chat(rnd)
        _, got = H.parse_text(MODEL, "\n".join(raw for _, raw in turns))
        right += [r for r, _ in got] == [r for r, _ in turns]
        total += 1
    assert right >= 0.95 * total


def test_table_and_rendering(spark):
    long = "\n".join(["User: hi", "Assistant: " + "Longer " * 40] * 5_000)
    texts = [None, "", "User: hi\nAssistant: <|system|> yes", long, "\n\n"]
    rows = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)] + [(0, None, "y")], "conv_id int, text string, turns string")
    got = rows.select("conv_id", H.parse(rows["text"], MODEL).alias("p"))
    got = {r["conv_id"]: r for r in got.select("conv_id", "p", H.render(got["p.turns"]).alias("out")).collect()}
    assert got[0]["p"]["turns"] == got[1]["p"]["turns"] == [] and got[0]["out"] == ""
    assert got[2]["out"] == "<|user|>\nhi\n<|end|>\n<|assistant|>\n< |system|> yes\n<|end|>"
    assert len(got[3]["p"]["turns"]) == 10_000 and got[3]["p"]["n_lines"] == 10_000
    assert got[4]["p"]["n_lines"] == 3
    assert rows.limit(0).select(H.parse(rows["text"], MODEL)).collect() == []


def test_parts_get_the_path_of_the_whole():
    rnd = random.Random(3)
    for n in (2, 5, 9):
        parts = [[tuple(rnd.randrange(k) for k in H.SIZES) for _ in range(rnd.randint(1, 6))] for _ in range(n)]
        ms = [H.transfer(MODEL, p) for p in parts]
        whole = H.viterbi(MODEL, list(itertools.chain(*parts)))
        np.testing.assert_allclose(H.chained(ms), H.transfer(MODEL, list(itertools.chain(*parts))))
        at = H.ends(ms, H.NOTHING, int(H.chained(ms)[H.NOTHING].argmax()))
        got = [H.viterbi(MODEL, p, b, e) for p, b, e in zip(parts, [H.NOTHING, *at], at)]
        assert list(itertools.chain(*got)) == whole


def conversations(spark, folder, rows):
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    return str(folder)


def test_long_transcripts_are_parsed_whole(spark, tmp_path, monkeypatch):
    rnd = random.Random(9)
    monkeypatch.setattr(H, "FAN", 3)  # several levels
    rows = [(c, k, "user" if k % 2 == 0 else "assistant", "\n".join("some words here" for _ in range(rnd.randint(1, 3))))
            for c, n in ((1, 500), (2, 3), (3, 64), (4, 65)) for k in range(n)]
    d = conversations(spark, tmp_path, rows)
    raw = Q.transcripts(spark, d).collect()
    assert {(r["conv_id"], r["part"]): len(r["turns"]) for r in raw if r["conv_id"] != 1} == {(2, 0): 3, (3, 0): 64, (4, 0): 64, (4, 1): 1}
    model = H.learn_table(F.col("turns"), spark.createDataFrame([([(r, t) for r, t in chat(random.Random(k))],) for k in range(50)],
                                                                "turns array<struct<role string, raw string>>"))
    assert np.allclose(model.start, H.learn([chat(random.Random(k)) for k in range(50)]).start)
    monkeypatch.setattr(H, "learn_table", lambda *a: model)
    got = {}
    for r in op6_chat_hmm(spark, d).orderBy("conv_id", "part").collect():
        roles = r["roles"].split(",")
        got.setdefault(r["conv_id"], []).extend(roles[1:] if r["continues"] and r["part"] else roles)
    for c in (1, 2, 3, 4):
        text = "\n".join(r["text"] for r in sorted((r for r in raw if r["conv_id"] == c), key=lambda r: r["part"]))
        assert got[c] == [role for role, _ in H.parse_text(model, text)[1]]


def test_rows_without_numbers_or_ids_come_in_parts(spark, tmp_path):
    rows = ([(None, None, "user", "hi")] * 200 + [(5, None, None, None)] * 130 + [(5, 1, "user", "a"), (5, 1, "user", "a"), (6, 2, "other", "")])
    d = conversations(spark, tmp_path, rows)
    raw = Q.transcripts(spark, d).collect()
    assert max(len(r["turns"]) for r in raw) == Q.TRANSCRIPT_TURNS and sum(len(r["turns"]) for r in raw) == len(rows)
    got = op6_chat_hmm(spark, d).collect()
    assert sorted((str(r["conv_id"]), r["part"]) for r in got) == sorted((str(r["conv_id"]), r["part"]) for r in raw)
    assert [r["n_lines"] for r in got if r["conv_id"] == 5 and r["part"] == 0] == [64]
    empty = tmp_path / "empty"
    assert op6_chat_hmm(spark, conversations(spark, empty, [])).collect() == []


def test_query(spark):
    d = "/root/testdata/sf0.1"
    got = op6_chat_hmm(spark, d).collect()
    assert 0.1 < np.mean([r["held_out"] for r in got]) < 0.3
    convs = spark.read.parquet(f"{d}/conversations.parquet").select("conv_id").distinct().count()
    assert len(got) == convs
    right = total = 0
    for r in (r for r in got if r["held_out"]):
        want, have = r["true_roles"].split(","), r["roles"].split(",")
        total += max(len(want), len(have))
        right += sum(a == b for a, b in zip(want, have))
    assert right >= 0.85 * total  # turn by turn, a quarter of them without a marker
