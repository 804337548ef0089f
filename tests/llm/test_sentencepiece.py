"""The Viterbi segmentation against all segmentations, against the library's
unigram reading of the same pieces and scores, and as a round trip."""

import itertools
import random

import pytest
import sentencepiece as library
from sentencepiece import sentencepiece_model_pb2 as pb

from kpiforge.llm import sentencepiece as S
from kpiforge.llm.queries import PIECE_MODEL, op2_sentencepiece

MODEL = S.load(PIECE_MODEL)
SEG, JOIN = S.Segmenter(MODEL), S.Joiner(MODEL)


@pytest.fixture(scope="module")
def unigram():
    m = pb.ModelProto()
    with open(PIECE_MODEL, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1  # read the same pieces as a unigram model
    return library.SentencePieceProcessor(model_proto=m.SerializeToString())


def score(ids):
    return sum(MODEL.pieces[i][1] for i in ids)


def test_never_below_the_librarys_unigram_model(unigram):
    rnd = random.Random(1)
    words = ["the", "erhthand", "Ouwhea", "thoning", "über", "schön", "éeauai", "ciónñes", "42", "x=1;", "don't", "-"]
    same = 0
    for _ in range(300):
        text = " ".join("".join(rnd.choices(words, k=rnd.randint(1, 3))) for _ in range(rnd.randint(1, 8)))
        mine, theirs = SEG.encode(text).tolist(), unigram.encode(text)
        assert score(mine) >= score(theirs)  # it keeps some pieces whole although two score more
        same += mine == theirs
    assert same > 100


def test_best_of_all_segmentations():
    known = {p: (s, i) for i, (p, s, kind) in enumerate(MODEL.pieces) if kind == "normal"}
    for word in ("▁thand", "▁ereron", "über", "▁▁▁a", "tionnd", "▁"):
        n, best = len(word), float("-inf")
        for cuts in itertools.product((0, 1), repeat=n - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], n]
            parts = [word[a:b] for a, b in itertools.pairwise(at)]
            if all(p in known for p in parts):
                best = max(best, sum(known[p][0] for p in parts))
        assert score(SEG.best(word)) == best


@pytest.mark.parametrize("text", ["", " ", "   ", "a", " a", "a ", "a  b\n\tc", "▁", "a▁b ▁▁ c", "​\0x", "日本語 😀", "퟿",
                                  "<s> </s> <0x0A> <unk>", "x" * 5000, "é" * 300 + " ́"])
def test_round_trip(text):
    assert JOIN.decode(SEG.encode(text).tolist()) == text


def test_unknown_characters_become_byte_pieces():
    assert [MODEL.pieces[i][0] for i in SEG.encode("\U0001f9ff").tolist()] == ["▁", "<0xF0>", "<0x9F>", "<0xA7>", "<0xBF>"]


def test_columns(spark):
    rows = [(1, "some text", "x"), (2, None, "y"), (3, "", "z"), (3, "", "z"), (None, "w " * 30_000, "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    codec = S.Codec(spark, MODEL)
    got = S.encode_docs(docs, codec)
    assert got.columns == ["doc_id", "ids"]
    back = got.select("doc_id", codec.decode("ids").alias("t")).collect()
    assert sorted((str(r[0]), r[1]) for r in back) == sorted((str(i), t or "") for i, t, _ in rows)
    assert S.encode_docs(docs.limit(0), codec).count() == 0


def test_query(spark):
    got = op2_sentencepiece(spark, "/root/testdata/sf0.001")
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert got.where("not same or n_ids <= 0").count() == 0


def test_decoding_many_at_once_like_one_by_one():
    import pyarrow as pa
    model = S.load(PIECE_MODEL)
    join, seg = S.Joiner(model), S.Segmenter(model)
    texts = ["", " ", "hello  world ", "▁ é 你好 🎉\n\t", " leading", "a" * 3000, "</s><0x41>"]
    lists = [seg.encode(t).tolist() for t in texts] + [None, [], [1, 2], [3 + 0xFF, 3 + 0xC3], [0, 3 + 0x41]]
    for part in (lists, lists[:7], lists[7:], []):
        arr = pa.array(part, pa.list_(pa.int32()))
        assert join.decode_all(arr).to_pylist() == [join.decode(x) if x else "" for x in part]
        assert join.decode_all(arr.slice(2)).to_pylist() == [join.decode(x) if x else "" for x in part[2:]]
    assert join.decode_all(pa.array(lists[:7], pa.list_(pa.int32()))).to_pylist() == texts
