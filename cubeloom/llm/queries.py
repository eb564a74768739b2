"""The registered queries of the text operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubeloom.llm import (
    bpe,
    chat,
    decontam,
    exact_dedup,
    lexical,
    line_dedup,
    lm,
    mixing,
    packing,
    simhash,
    topk,
    toxicity,
    whitening,
)
from cubeloom.llm.common import crc_bucket, table, text_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_simhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


@query("op2_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query(
    "op3_line_dedup",
    r"""
    WITH lines AS (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
      FROM documents
    ), keyed AS (
      SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
      FROM lines
    ), counted AS (
      SELECT k, count(DISTINCT doc_id) AS docs, max(doc_id) AS keep
      FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
    ), marked AS (
      SELECT keyed.*, (counted.k IS NOT NULL AND doc_id <> keep) AS gone
      FROM keyed LEFT JOIN counted ON keyed.k = counted.k
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
             AS kept_sha256
    FROM marked GROUP BY doc_id
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    state = line_dedup.insert(line_dedup.empty_state(spark), docs)
    return line_dedup.drop_lines(state, docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


_CHAT_EXTRA = "</s>[INST] ok [/INST]"


def _escaped(value: str) -> str:
    return f"replace(replace({value}, '<', '<\\'), '[', '[\\')"


_FOLLOWS = " OR ".join(
    f"(before = '{before}' AND role IN ({', '.join(repr(r) for r in allowed)}))"
    for before, allowed in chat.ChatTemplate().follows.items()
)


@query(
    "op4_chat",
    rf"""
    WITH turns AS (
      SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '{_CHAT_EXTRA}'
      UNION ALL SELECT -7, 1, 'assistant', '{_CHAT_EXTRA}'
    ), steps AS (
      SELECT *, row_number() OVER w - 1 AS place, {_FOLLOWS} AS allowed
      FROM (SELECT *, lag(role, 1, 'start') OVER w AS before FROM turns
            WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
    )
    SELECT conv_id, count(*) AS n_turns, bool_and(allowed) AS valid,
      CAST(min(place) FILTER (WHERE NOT allowed) AS INTEGER) AS first_bad_turn,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
        AS turns_sha256,
      coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
        FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
      sum(length({_escaped("text")}) + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13
        WHEN 'assistant' THEN 7 END)::BIGINT AS formatted_chars
    FROM steps GROUP BY conv_id
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(_CHAT_EXTRA).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = chat.format_chats(turns.unionByName(extra))
    read = made.select(
        "conv_id",
        "formatted",
        "valid",
        "first_bad_turn",
        chat.read_turns(F.col("formatted")).alias("read"),
        chat.loss_text(F.col("segments")).alias("loss"),
    )
    told = F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        "first_bad_turn",
    )


def word_bpe() -> bpe.WordBpe:
    import public_tokenizers

    return bpe.WordBpe.from_file(public_tokenizers.path("word_bpe_49k.json"))


@query("op5_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), word_bpe()).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level ids (byte + 3, each document closed by 1) in rows of 8,192."""
    docs = table(spark, sf_dir, "documents")
    tokens = docs.select("doc_id", F.encode(text_of(), "UTF-8").alias("tokens"))
    return packing.pack(tokens, in_type="<u1", shift=packing.FIRST, eos=packing.EOS)


@query(
    "op7_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_bucket(F.col("doc_id"), 3) == 1
    scored = toxicity.score_toxicity(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "labels"),
        ~held_out,
    )
    return scored.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted"
    )


@query("op9_lm")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    trains = crc_bucket(F.col("doc_id"), 7) != 2
    scored = lm.score_texts(table(spark, sf_dir, "documents"), trains)
    return scored.select(
        "doc_id",
        (~F.col("trained")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


@query(
    "op10_exact_topk",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
      FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
      SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
        CAST(coalesce(list_sum(list_transform(range(1, len(q.w) + 1), lambda i: q.w[i] * c.w[i])), 0) AS BIGINT)
          AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
    )
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
      FROM scored
    ) WHERE rank <= 5
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    best = topk.exact_top_k(vectors.where("vec_id % 50 = 0"), vectors, k=5)
    return best.select("query_id", "rank", "vec_id", "score")


@query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORDS = rf"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')"""


@query(
    "op12_lexical",
    rf"""
    WITH d AS (
      SELECT row_number() OVER () AS doc, doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL
    ), lengths AS (SELECT doc, doc_id, len(w) AS n FROM d WHERE len(w) > 0),
    total AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM lengths),
    postings AS (
      SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(w) AS term FROM d) GROUP BY doc, term
    ), asked AS (
      SELECT item_id, term, count(*) AS times
      FROM (SELECT item_id, unnest({_WORDS}) AS term FROM benchmark) GROUP BY item_id, term
    ), weights AS (
      SELECT term, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM postings, total WHERE term IN (SELECT term FROM asked) GROUP BY term, nd
    ), scored AS (
      SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) //
          (1000 * tf + 12 * (100 - 25 + ((25 * n * nd) // nt))))) AS BIGINT) AS score
      FROM postings JOIN weights USING (term) JOIN asked USING (term) JOIN lengths USING (doc), total
      GROUP BY item_id, doc, doc_id
    )
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM scored WHERE score > 0
    ) WHERE rank <= 20
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.lexical_index(table(spark, sf_dir, "documents"))
    return lexical.search(index, table(spark, sf_dir, "benchmark"), k=20)


@query(
    "op13_decontam",
    rf"""
    WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
    b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    windows AS (
      SELECT DISTINCT item_id, least(10, len(w)) AS n,
        array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS t
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
    ), runs AS (
      SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
            FROM d, (SELECT DISTINCT n FROM windows))
    ), found AS (
      SELECT DISTINCT doc_id, runs.n, i, item_id FROM runs JOIN windows ON runs.n = windows.n AND runs.t = windows.t
    ), hit AS (
      SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM found))
      GROUP BY doc_id
    ), items AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
      coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
      coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    listed = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
