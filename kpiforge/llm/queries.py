"""The registered queries of the operators, and the SQL of those it can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, byte_bpe, chat_hmm, compression_rules, jaccard_join, kmeans_tree, line_crf, merkle, mixing, packing, sentencepiece,
               sharding, token_rollup, toxicity)
from ..session import scratch_path
from .labelled import labelled_texts
from .ordered import running
from .storage import table, visible, written

Query = Callable[[SparkSession, str], DataFrame]


def op1_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20."""
    return kmeans_tree.search(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op2_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str = PIECE_MODEL) -> DataFrame:
    """Every document encoded to pieces and decoded again: the number of ids,
    a hash of the ids, the bytes of the decoded text, and whether it is the text."""
    codec = sentencepiece.Codec(spark, sentencepiece.load(model_path))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", codec.encode(F.col("text")).alias("ids"))
    docs = docs.select("doc_id", "text", "ids", codec.decode(F.col("ids")).alias("decoded"))
    return docs.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"),
                       F.octet_length("decoded").cast("bigint").alias("decoded_bytes"),
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("same"))


# The domain of a source, by a rule that stands in for a catalogue of sources: the first hex digit of its MD5.
DOMAIN_SQL = """case when source is null then 'other'
    when substr(md5(source), 1, 1) in ('0', '1', '2', '3', '4', '5') then 'web'
    when substr(md5(source), 1, 1) in ('6', '7', '8', '9', 'a') then 'books' else 'reference' end"""
# Weights among siblings, by level
WEIGHT_SQL = ("case domain when 'web' then 50 when 'books' then 30 when 'reference' then 20 else 1 end",
              "case lang when 'en' then 60 when 'de' then 20 when 'fr' then 15 else 5 end",
              "case when length(source) = 4 then 2 else 1 end")
BUDGET, EPOCHS, SEED = 0.8, 4, 17
WORDS = r"[^\x20\x09-\x0D]+"


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` mixed by the weights above, to four fifths of their words."""
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORDS))
    return mixing.mix(docs, F.expr(DOMAIN_SQL), words, [F.expr(w) for w in WEIGHT_SQL], BUDGET, EPOCHS, SEED)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the mixture takes, a row for each epoch that takes them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixed(docs).select("doc_id", F.col("_domain").alias("domain"), "lang", "source",
                              F.col("_tokens").alias("n_words"), F.col("_epoch").alias("epoch"))


def _level_sql(k: int) -> str:
    """One level of the budget tree: caps, fill order, quotas."""
    path = ", ".join(mixing.LEVELS[:k + 1])
    family = "partition by " + (", ".join(mixing.LEVELS[:k]) or "1")
    up = f"(select {BUDGET_SQL} as quota)" if k == 0 else f"q{k - 1}"
    same = " and ".join(f"n.{c} is not distinct from u.{c}" for c in mixing.LEVELS[:k]) or "true"
    before = f"({family} order by cap / weight, {mixing.LEVELS[k]} nulls first rows between unbounded preceding and 1 preceding)"
    return f"""n{k} as (select {path}, sum(tokens) * {EPOCHS} as cap, max(w{k}) as weight from leaves group by all),
b{k} as (select n.*, u.quota as budget from n{k} n join {up} u on {same} where n.cap > 0),
f{k} as (select *, cap * (sum(weight) over ({family}) - coalesce(sum(weight) over {before}, 0))
    <= weight * (budget - coalesce(sum(cap) over {before}, 0)) as is_full from b{k}),
q{k} as (select {path}, case when is_full then cap else least(cap, weight
    * (budget - coalesce(sum(cap) filter (where is_full) over ({family}), 0))
    // nullif(coalesce(sum(weight) filter (where not is_full) over ({family}), 0), 0)) end as quota from f{k})"""


BUDGET_SQL = f"(select cast(floor(sum(tokens) * {BUDGET}::double) as bigint) from leaves)"


def _op3_sql() -> str:
    leaf = " and ".join(f"{{0}}.{c} is not distinct from {{1}}.{c}" for c in mixing.LEVELS)
    key = f"md5('{SEED}|' || (whole + 1) || '|' || coalesce(doc_id::varchar, ''))"
    return f"""with docs as (select doc_id, lang, source, {DOMAIN_SQL} as domain,
    len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) as tokens from documents),
leaves as (select domain, lang, source, sum(tokens)::hugeint as tokens, {", ".join(f"max({w}) as w{k}" for k, w in enumerate(WEIGHT_SQL))}
    from docs group by all),
{", ".join(_level_sql(k) for k in range(3))},
parts as (select l.domain, l.lang, l.source, q.quota // l.tokens as whole, q.quota % l.tokens as rest
    from leaves l join q2 q on {leaf.format("l", "q")} where l.tokens > 0),
placed as (select d.*, p.whole, p.rest, {key} as place from docs d join parts p on {leaf.format("d", "p")}),
summed as (select domain, lang, source, rest, place, sum(tokens) as tokens from placed where rest > 0 group by all),
ran as (select *, coalesce(sum(tokens) over (partition by domain, lang, source order by place
    rows between unbounded preceding and 1 preceding), 0) as before from summed),
cuts as (select domain, lang, source, max(place) as cut from ran where before < rest group by all),
taken as (select p.*, whole + case when place <= cut then 1 else 0 end as n
    from placed p left join cuts c on {leaf.format("p", "c")})
select doc_id, domain, lang, source, tokens::bigint as n_words, unnest(range(1, n::bigint + 1))::int as epoch from taken where n > 0"""


# Tokenizer versions: rank files and the pattern that cuts texts before merging
RANKS = {"byte_bpe_50k": "/opt/tokenizers/byte_bpe_50k.tiktoken", "byte_bpe_multi_50k": "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"}
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def token_changes(spark: SparkSession, sf_dir: str, version: str, revised: bool = False) -> DataFrame:
    """Stand-in change log: inserts of all documents under a tokenizer version;
    or, ``revised``, new counts of the texts of several lines, joined to one
    line, and deletes of the documents labelled as of low quality."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    count = token_rollup.Counter(spark, token_rollup.ranks_of(RANKS[version]), CUT)
    tokens = [F.lit(version).alias("tokenizer"), "source", "lang"]
    if not revised:
        return docs.select(F.lit(0).alias("seq"), F.lit("insert").alias("op"), "doc_id", *tokens, count(F.col("text")).alias("n_tokens"))
    joined = docs.where(F.contains("text", F.lit("\n"))).withColumn("text", F.translate("text", "\n", " "))
    bad = table(spark, sf_dir, "labels").where("quality = 0").select("doc_id")
    return (joined.select(F.lit(0).alias("seq"), F.lit("revise").alias("op"), "doc_id", *tokens, count(F.col("text")).alias("n_tokens"))
            .unionAll(bad.select(F.lit(1).alias("seq"), F.lit("delete").alias("op"), "doc_id", F.lit(version),
                                 F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("long"))))


def op4_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by source, language and tokenizer version after three batches: all
    documents under one tokenizer, revised counts and deletes, all documents
    under a second one; the second batch is delivered twice."""
    first, second = RANKS
    store = token_rollup.Rollup(spark, scratch_path(spark, "rollup")).create()
    store.commit(1, token_changes(spark, sf_dir, first))
    revised = token_changes(spark, sf_dir, first, revised=True)
    store.commit(2, revised)
    store.commit(2, revised)
    store.commit(3, token_changes(spark, sf_dir, second))
    return store.totals()


# Labelled documents of each label that a classifier learns from, at most
FIT_ROWS, LEXICON_ROWS = 5_000, 25_000


def fold_of(doc_id: str, folds: int):
    """The fold of a document: CRC-32 of its id as text, modulo the folds."""
    return F.crc32(F.col(doc_id).cast("string")) % folds


def op5_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; fold 0 of 5 is held out of learning.
    Labels of one class teach nothing: all documents then get 0.5."""
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    field = line_crf.learn(labelled_texts(docs, labels, "quality", fold_of("doc_id", 5) != 0, FIT_ROWS))
    held = F.coalesce(fold_of("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    if field is None:
        field = line_crf.Field((0.0,) * line_crf.N_NODE)
    return line_crf.score(docs, field).select("doc_id", held, "score", "predicted", "goodness", "n_lines")


# Turns of a part of a transcript; transcripts of known roles to learn from, about
TRANSCRIPT_TURNS, CHAT_ROWS = 64, 2_000


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in raw transcripts (key, conv_id, part, turns of role and raw text,
    text): the turns of a conversation under each other, in one of four marker styles, a
    quarter of the turns without a marker.  Turns come by number, those without
    one first, then by role and text; each TRANSCRIPT_TURNS of them are a part.
    Rows without conv_id are one transcript."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    style = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    human = F.when(F.col("role") == "user", "Human").when(F.col("role") == "assistant", "AI").otherwise(F.initcap("role"))
    mark = (F.when(style == 0, F.concat(F.initcap("role"), F.lit(": "))).when(style == 1, F.concat(human, F.lit(": ")))
            .when(style == 2, F.concat(F.lit("### "), F.initcap("role"), F.lit("\n")))
            .otherwise(F.concat(F.lit("["), F.col("role"), F.lit("] "))))
    bare = (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4)) == 0) | F.col("role").isNull()
    c = c.select("conv_id", "turn", "role", F.concat(F.when(bare, F.lit("")).otherwise(mark), "text").alias("raw"),
                 F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-")).alias("key"), F.lit(1).cast("long").alias("one"))
    c = running(c, ["turn", "role", "raw"], "one", "key", "turns")
    return (c.groupBy("key", "conv_id", F.expr(f"_row div {TRANSCRIPT_TURNS}").alias("part"))
            .agg(F.transform(F.sort_array(F.collect_list(F.struct("_row", "role", "raw"))),
                             lambda t: F.struct(t["role"].alias("role"), t["raw"].alias("raw"))).alias("turns"))
            .withColumn("text", F.array_join("turns.raw", "\n")))


def op6_chat_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transcript with its recovered roles and canonical rendering, one
    row per part; fold 0 of 5 is held out, and the model learns from the first
    parts of about 2,000 of the others.  The parts of a long transcript get the roles
    that one Viterbi over all of it gives; ``continues`` marks a part that
    opens inside a turn."""
    raw = written(transcripts(spark, sf_dir), "transcripts")
    held = F.pmod(F.xxhash64("conv_id", F.lit(7)), F.lit(5)) == 0
    known = raw.where((F.col("part") == 0) & ~held)
    n = max(1, known.count())
    model = chat_hmm.learn_table(F.col("turns"), known.where(
        F.pmod(F.xxhash64("conv_id", F.lit(8)), F.lit(1_000_000)) < 1_000_000 * min(1.0, CHAT_ROWS / n)))
    long = raw.where("part > 0").select("key").distinct()
    states = chat_hmm.part_states(raw.join(long, "key", "left_semi").select("key", "part", "text"), model)
    raw = raw.join(states, ["key", "part"], "left")
    got = raw.select("conv_id", "part", held.alias("held_out"), F.col("turns.role").alias("true_roles"),
                     chat_hmm.parse(F.col("text"), model, F.col("before"), F.col("last")).alias("p"))
    return got.select("conv_id", "part", "held_out", "p.n_lines", "p.continues", F.size("p.turns").alias("n_turns"),
                      F.array_join("p.turns.role", ",").alias("roles"), F.array_join("true_roles", ",", "").alias("true_roles"),
                      chat_hmm.render(F.col("p.turns")).alias("rendered"))


def toxicity_lexicon(spark: SparkSession, sf_dir: str) -> toxicity.Lexicon:
    """The lexicon learned from the labelled documents outside fold 2 of 4."""
    return toxicity.learn(labelled_texts(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "toxic", fold_of("doc_id", 4) != 2,
        LEXICON_ROWS))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; fold 2 of 4 is held out of learning."""
    lex = toxicity_lexicon(spark, sf_dir)
    return toxicity.score(table(spark, sf_dir, "documents"), lex).select(
        "doc_id", F.coalesce(fold_of("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", "predicted", "n_hits")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the documents whose 5-word shingle sets have a Jaccard similarity of 0.75 or more."""
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and compression-band verdict of every document."""
    return compression_rules.judge(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 contiguous shards of near-equal bytes."""
    return sharding.assign_shards(table(spark, sf_dir, "documents"), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


BYTE_FILE = "/opt/tokenizers/byte_bpe_50k.json"


def op11_alignment(spark: SparkSession, sf_dir: str, bpe_path: str = BYTE_FILE, model_path: str = PIECE_MODEL) -> DataFrame:
    """Groups and links between two tokenizers' tokens in every document."""
    return alignment.align(table(spark, sf_dir, "documents"), byte_bpe.load(bpe_path), alignment.load(model_path))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots and proof, and whether it still verifies
    after the line ends of every other document (by the CRC-32 of its id) were lost."""
    lost = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return merkle.seal(table(spark, sf_dir, "documents"), lost).select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


def _forest_sql(name: str, leaves: str) -> str:
    """The levels of a forest over ``leaves`` (grp, idx, digest, folded), and its leaves followed up to the trees' roots."""
    run = f"partition by grp, level, idx // {merkle.FAN} order by idx rows between"
    return f"""{name}_nodes(grp, level, idx, digest, n) as (select grp, 0, idx, digest, count(*) over (partition by grp) from {leaves}
    union all select grp, level + 1, idx // {merkle.FAN}, sha256(string_agg(digest, '' order by idx)), any_value((n + {merkle.FAN - 1}) // {merkle.FAN})
    from {name}_nodes where n > 1 group by grp, level, idx // {merkle.FAN}),
{name}_runs as (select grp, level, idx, coalesce(string_agg(digest, '') over ({run} unbounded preceding and 1 preceding), '') as l,
    coalesce(string_agg(digest, '') over ({run} 1 following and unbounded following), '') as r from {name}_nodes where n > 1),
{name}_up(grp, leaf, level, idx, folded, proof) as (select grp, idx, 0, idx, folded, '' from {leaves}
    union all select u.grp, u.leaf, u.level + 1, u.idx // {merkle.FAN}, sha256(l || folded || r), proof || l || r
    from {name}_up u join {name}_runs s on u.grp = s.grp and u.level = s.level and u.idx = s.idx),
{name}_tops as (select grp, level, digest from {name}_nodes where n = 1),
{name} as (select u.grp, u.leaf as idx, t.digest as top, folded, proof from {name}_up u join {name}_tops t on u.grp = t.grp and u.level = t.level)"""


def _op12_sql() -> str:
    def leaf(text: str) -> str:
        fields = [f"case when {c} is null then '-' else strlen({c}::varchar) || ':' || {c}::varchar end" for c in (*merkle.FIELDS[:-1], text)]
        return f"sha256({' || '.join(fields)})"

    return f"""with recursive bits(n, c, k) as (select range, range, 0 from range(256) union all
    select n, case when c % 2 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end, k + 1 from bits where k < 8),
crc as (select list(c order by n) as t from bits where k = 8),
docs as (select coalesce('s' || source, '') as grp, doc_id, {leaf("text")} as digest, case when coalesce(list_reduce(
    [4294967295::bigint] || [ascii(c)::bigint for c in string_split(doc_id::varchar, '')],
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])) % 2 = 1, false) then {leaf("replace(text, chr(10), '')")} else {leaf("text")} end as folded
    from documents, crc),
leaves as (select *, row_number() over (partition by grp order by doc_id nulls first, digest) - 1 as idx from docs),
{_forest_sql("trees", "leaves")},
subroots as (select '' as grp, grp as source, digest, digest as folded, row_number() over (order by grp) - 1 as idx from trees_tops),
{_forest_sql("roots", "subroots")},
climb(source, leaf, level, idx, folded) as (select t.grp, t.idx, 0, s.idx, t.folded from trees t join subroots s on t.grp = s.source
    union all select c.source, c.leaf, c.level + 1, c.idx // {merkle.FAN}, sha256(l || folded || r)
    from climb c join roots_runs s on c.level = s.level and c.idx = s.idx)
select l.doc_id, l.digest as leaf, t.top as subroot, r.top as root, sha256(t.proof || r.proof) as proof_sha256, c.folded as folded_root,
    c.folded = r.top as verified
from leaves l join trees t on l.grp = t.grp and l.idx = t.idx join subroots s on s.source = l.grp join roots r on r.idx = s.idx
join climb c on c.source = l.grp and c.leaf = l.idx join roots_tops o on o.level = c.level"""


def op13_packing(spark: SparkSession, sf_dir: str, bpe_path: str = BYTE_FILE) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), byte_bpe.load(bpe_path))


def _ready(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        visible(spark)
        return query(spark, sf_dir)
    return run


def queries() -> dict[str, Query]:
    every = (op1_kmeans_tree, op2_sentencepiece, op3_mixing, op4_token_rollup, op5_quality_crf, op6_chat_hmm, op7_toxicity,
             op8_jaccard_join, op9_quality_rules, op10_sharding, op11_alignment, op12_merkle, op13_packing)
    return {f.__name__: _ready(f) for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op3_mixing": _op3_sql(), "op12_merkle": _op12_sql()}
