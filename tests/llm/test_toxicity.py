"""Folding, matching, exceptions and learning of the toxicity lexicon."""

import math

from kpiforge.llm import toxicity as X
from kpiforge.llm.queries import op7_toxicity

LEX = X.Lexicon((("idiot", 5.0), ("scum", 4.0), ("scu", 1.0)), ("scum bucket", "idiotic test"))


def found(text, lex=LEX):
    folded = X.fold(text)
    return [(folded[s:e], w) for s, e, w in X.hits(lex, folded)]


def test_folding():
    assert X.fold("1D10T") == "idiot"
    assert X.fold("ѕсum Іdіοt") == "scum idiot"  # Cyrillic and Greek letters
    assert X.fold("ｓｃｕｍ") == "scum"
    assert X.fold("SC​UM") == "scum"
    assert X.fold("Ídïót") == "idiot"
    assert X.fold("$cum") == "scum"


def test_hits_at_word_starts_only():
    assert found("an idiot, IDIOTS!") == [("idiot", 5.0), ("idiot", 5.0)]
    assert found("videoidiot") == []
    assert found("scum") == [("scum", 4.0)]  # the heaviest of those that start together
    assert found("") == []


def test_exceptions():
    assert found("a scum bucket and scum") == [("scum", 4.0)]
    assert found("idiotic test") == []
    assert found("idiotic tests") == [("idiot", 5.0)]


def brute_density(text):
    folded, total = X.fold(text), 0.0
    for k in range(len(folded)):
        if k and folded[k - 1].isalpha():
            continue
        own = [w for s, w in LEX.stems if folded.startswith(s, k)]
        inside = any(folded.startswith(p, j) and not folded[j + len(p):j + len(p) + 1].isalpha() and j <= k
                     and not (j and folded[j - 1].isalpha()) and any(k + len(s) <= j + len(p) for s, w in LEX.stems if folded.startswith(s, k) and w == max(own, default=0))
                     for p in LEX.exceptions for j in range(max(0, k - len(p)), k + 1))
        if own and not inside:
            total += max(own)
    return total / math.sqrt(1 + (1 + text.count(" ") + text.count("\n")) / 100)


def test_scores_of_a_table(spark):
    texts = ["clean words here", "you idiot", "y0u 1d10t " * 5, None, "", "scum bucket", "word " * 50_000 + "scum", "idiot " * 3000]
    docs = spark.createDataFrame([(k, t, 0.5) for k, t in enumerate(texts)] + [(1, "you idiot", 0.1), (None, "scum", 0.2)],
                                 "doc_id long, text string, score double")
    got = X.score(docs, LEX).collect()
    assert len(got) == 10
    by = {r["doc_id"]: r for r in got}
    for k, t in enumerate(texts):
        assert abs(by[k]["score"] - X.score_of(LEX, brute_density(t or ""))) < 1e-12
        assert by[k]["predicted"] == int(by[k]["score"] >= 0.3)
    assert by[3]["score"] == by[4]["score"] == by[0]["score"] < by[6]["score"] < by[1]["score"] < by[7]["score"]
    assert X.drop_toxic(docs, LEX).columns == docs.columns
    assert X.score(docs.limit(0), LEX).collect() == []


def test_learning(spark):
    import random
    rnd = random.Random(0)
    word = lambda: "".join(rnd.choices("aeioubcdfglmnprst", k=6))
    clean = [" ".join(word() for _ in range(40)) for _ in range(300)]
    bad = [" ".join([word() for _ in range(20)] + [f"grobel{rnd.choice(['n', 'ig', 'ung'])}"] + [word() for _ in range(20)]) for _ in range(40)]
    bad += ["plague copied text with marker words"] * 30  # copies of one text teach nothing
    clean += [f"{word()} grobelix {word()}" for _ in range(6)]  # an inflected form that is clean
    rows = [(k, t, 0, 1.0) for k, t in enumerate(clean)] + [(1000 + k, t, 1, 1.0) for k, t in enumerate(bad)]
    lex = X.learn(spark.createDataFrame(rows, "doc_id long, text string, label int, weight double"))
    assert lex.stems and {s[:6] for s, _ in lex.stems} == {"grobel"}
    assert "grobelix" in lex.exceptions
    assert X.score_of(lex, X.density(lex, "one GR0BELig here")[1]) >= 0.3 > X.score_of(lex, X.density(lex, "a grobelix")[1])
    assert X.learn(spark.createDataFrame(rows[:10], "doc_id long, text string, label int, weight double")).stems == ()


def words(rnd, n, k=6):
    return " ".join("".join(rnd.choices("aeioubcdfglmnprst", k=k)) for _ in range(n))


def learned(spark, clean, bad):
    rows = [(k, t, 0, 1.0) for k, t in enumerate(clean)] + [(10_000 + k, t, 1, 1.0) for k, t in enumerate(bad)]
    return X.learn(spark.createDataFrame(rows, "doc_id long, text string, label int, weight double"))


def test_copies_neither_bring_nor_take_a_stem(spark):
    import random
    rnd = random.Random(1)
    clean = [words(rnd, 30) for _ in range(200)]
    bad = [f"{words(rnd, 10)} grobel {words(rnd, 10)}" for _ in range(30)]
    copied = f"{words(rnd, 10)} grobel plagueword {words(rnd, 10)}"
    lex = learned(spark, clean, bad + [copied] * 400)
    assert {s[:6] for s, _ in lex.stems} == {"grobel"}
    assert X.score_of(lex, X.density(lex, copied)[1]) >= 0.3
    assert lex.stems == learned(spark, clean, bad + [copied]).stems


def test_rare_slur_among_many_ordinary_words(spark):
    import random
    rnd = random.Random(2)
    usual = ["".join(rnd.choices("aeioubcdfglmnprst", k=12)) for _ in range(3000)]  # 9 word starts each
    texts = [" ".join(rnd.sample(usual, 600)) for _ in range(110)]
    bad = [f"{t} {words(rnd, 1)} grobel {words(rnd, 1)}" if k < 6 else t for k, t in enumerate(texts[:60])]
    clean = texts[60:] + [" ".join(usual)] * 60 + [words(rnd, 5) for _ in range(150)]
    lex = learned(spark, clean, bad)
    assert [s for s, _ in lex.stems if s.startswith("grob")] == ["grobel"]


def test_all_exceptions_stay(spark):
    import random
    rnd = random.Random(3)
    bad = [f"{words(rnd, 10)} grobel {words(rnd, 10)}" for _ in range(300)]
    forms = ["grobel" + "".join(rnd.choices("abcdefghij", k=5)) for _ in range(2000)]  # each with two neighbours, in 4 documents
    clean = [" ".join(f"{f[6:]}x {f} {f[6:]}y" for f in forms)] * 4 + [words(rnd, 30) for _ in range(3000)]
    lex = learned(spark, clean, bad)
    assert "grobel" in {s for s, _ in lex.stems}
    assert len(lex.exceptions) > 5000 and set(forms) <= set(lex.exceptions)


def test_short_words_match_whole(spark):
    import random
    rnd = random.Random(4)
    bad = [f"{words(rnd, 10)} {rnd.choice(['vog', 'VOG', 'v0g', 'xu'])} {words(rnd, 10)}" for _ in range(60)]
    lex = learned(spark, [words(rnd, 30) + " vogabel" for _ in range(300)], bad)
    assert {s for s, _ in lex.stems} == {"vog ", "xu "}
    assert found("a vog, vogabel, XU", lex) == [("vog", dict(lex.stems)["vog "]), ("xu", dict(lex.stems)["xu "])]


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    got = op7_toxicity(spark, d)
    assert got.count() == 10_000
    both = got.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").select("toxic", "predicted").collect()
    assert len(both) > 500
    right = {y: [r for r in both if r["toxic"] == y and r["predicted"] == y] for y in (0, 1)}
    assert len(right[0]) >= 0.98 * sum(r["toxic"] == 0 for r in both)
    assert len(right[1]) >= 0.95 * sum(r["toxic"] == 1 for r in both)


def test_a_long_text_of_hits_and_exceptions_takes_linear_time():
    import time
    lex = X.Lexicon((("vile", 2.0), ("rotten", 3.0)), ("vile weather", "rotten"))
    texts = ["vile weather and vile deeds rotten " * n for n in (1_000, 45_000)]  # 35 KB, 1.5 MB
    for n, text in zip((1_000, 45_000), texts):
        at = time.perf_counter()
        got = X.hits(lex, X.fold(text))
        assert len(got) == n and {text[s:e] for s, e, _ in got[:50]} == {"vile"}
        assert time.perf_counter() - at < 10


def test_covered_hits_against_every_span():
    import random
    rnd = random.Random(3)
    lex = X.Lexicon((("bad", 1.0), ("worse", 2.0)), ("not bad", "bad luck", "worse for wear"))
    for _ in range(300):
        text = " ".join(rnd.choices(["not", "bad", "luck", "worse", "for", "wear", "badly"], k=12))
        words, want, at = text.split(" "), [], 0
        spans = [(m.start(), m.start() + len(p)) for p in lex.exceptions for m in __import__("re").finditer(rf"(?=\b{p}\b)", text)]
        for w in words:
            stem = "worse" if w == "worse" else "bad" if w.startswith("bad") else None
            if stem and not any(x <= at and at + len(stem) <= y for x, y in spans):
                want.append((at, at + len(stem)))
            at += len(w) + 1
        assert [(s, e) for s, e, _ in X.hits(lex, text)] == want
