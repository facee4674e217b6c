"""The operators of this subpackage as queries over the given tables, with SQL where it can state the result."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import ann, audit, chat, exact, lengths, licenses, mixing, packing, pii, repair, simhash, tokenfiles, toxicity
from lakeops.llm.tokens import public_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Target weights of the mix; sources not named here weigh 1.
MIX_WEIGHTS = {"src0": 4, "src1": 2, "src2": 2}
SEQUENCE = 4096


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query(
    "op1_exact_dedup",
    """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
        doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
)
def op1(spark, folder):
    return exact.label_copies(table(spark, folder, "documents"))


@query("op2_chat_format")
def op2(spark, folder):
    """All conversations and one whose texts hold control strings."""
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.chat_digest(chat.format_chats(rows))


_WEIGHT = " ".join(["CASE source", *(f"WHEN '{s}' THEN {w}" for s, w in MIX_WEIGHTS.items()), "ELSE 1 END"])
# The schedule slot by slot, cycle by cycle.
_SCHEDULE = f"""WITH RECURSIVE docs AS (
        SELECT doc_id, source, chars, coalesce(sum(chars) OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, chars
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS before
        FROM (SELECT doc_id, source, length(coalesce(text, ''))::bigint AS chars FROM documents)),
    sources AS (
        SELECT source, {_WEIGHT}::bigint AS weight, greatest(1, (sum(chars)::bigint + {mixing.BLOCK_CHARS - 1}) // {mixing.BLOCK_CHARS}) AS blocks FROM docs GROUP BY source),
    cycles AS (
        SELECT q, sum(w)::bigint AS slots, list({{'s': source, 'w': w}} ORDER BY source NULLS FIRST) AS active
        FROM (SELECT *, unnest(range((blocks + weight - 1) // weight)) AS q, least(weight, blocks - q * weight) AS w FROM sources) GROUP BY q),
    edf AS (
        SELECT q, slots, active, 0::bigint AS t, list_transform(active, lambda x: 0::bigint) AS done, 0::bigint AS i, 0::bigint AS r FROM cycles
        UNION ALL
        SELECT q, slots, active, t + 1, list_transform(done, lambda d, j: d + CASE WHEN j = best.i THEN 1 ELSE 0 END), best.i, done[best.i]
        FROM (SELECT *, list_sort(list_filter(list_transform(active, lambda x, j: CASE WHEN done[j] < x.w AND done[j] * slots // x.w <= t
                THEN {{'due': ((done[j] + 1) * slots + x.w - 1) // x.w, 'i': j}} END), lambda c: c IS NOT NULL))[1] AS best
              FROM edf WHERE t < slots)),
    starts AS (SELECT q, sum(slots) OVER (ORDER BY q) - slots AS start FROM cycles),
    taken AS (
        SELECT q, active[i].s AS source, q * weight + r AS block, start + t - 1 AS slot, start + r * slots // active[i].w AS released,
            start + ((r + 1) * slots + active[i].w - 1) // active[i].w AS due
        FROM edf JOIN starts USING (q) JOIN sources ON sources.source IS NOT DISTINCT FROM active[i].s WHERE t > 0)
    SELECT doc_id, d.source, chars, d.block, slot::bigint AS slot, released::bigint AS released, due::bigint AS due
    FROM (SELECT docs.*, least(before // {mixing.BLOCK_CHARS}, blocks - 1) AS block FROM docs JOIN sources ON docs.source IS NOT DISTINCT FROM sources.source) d
    JOIN taken ON taken.source IS NOT DISTINCT FROM d.source AND taken.block = d.block"""


@query("op3_source_mixing", _SCHEDULE)
def op3(spark, folder):
    return mixing.schedule(table(spark, folder, "documents"), MIX_WEIGHTS)


def learns() -> Column:
    """Rows of the labels a model may learn from; the others are held out."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 != 0


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.train(*toxicity.labelled_sample(docs, labels, learns()))


@query("op4_toxicity")
def op4(spark, folder):
    docs = table(spark, folder, "documents")
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity_model(docs, table(spark, folder, "labels")))
    rows = scored.select("_row.doc_id", "score")
    return rows.select(
        "doc_id", F.coalesce(~learns(), F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op5_personal_data")
def op5(spark, folder):
    return pii.personal_data(table(spark, folder, "documents"))


@query("op6_nearest_neighbours")
def op6(spark, folder):
    return ann.search(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query("op7_sequence_packing")
def op7(spark, folder):
    return packing.pack(table(spark, folder, "documents"), public_path("word_bpe_49k.json"), 1, SEQUENCE)


@query("op8_simhash_near_dedup")
def op8(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"), words=4, max_bits=4)


@query("op9_length_histogram")
def op9(spark, folder):
    lengths_of = lengths.token_lengths(table(spark, folder, "documents"), public_path("byte_bpe_50k.json"))
    return lengths.length_histogram(lengths_of)


@query("op10_token_files")
def op10(spark, folder):
    return tokenfiles.token_table(table(spark, folder, "documents"), public_path("byte_bpe_50k.json"), 0)


FILTERS = "ABCDE"


@query(
    "op11_filter_audit",
    """WITH texts AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
            list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents),
    said AS (SELECT doc_id, max((quality = 1)::int) AS good, max((toxic = 1)::int) AS toxic FROM labels GROUP BY doc_id),
    failed AS (
        SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, (len(words) < 200)::int + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::int
            + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::int + 8 * regexp_matches(t, '[#$%&*|]')::int
            + 16 * coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)::int AS mask
        FROM texts d LEFT JOIN said ON said.doc_id = d.doc_id),
    cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, mask),
    f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    orders AS (
        SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
        WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    steps AS (
        SELECT filter_order, k::int AS step, 1 << (ascii(filter_order[k]) - 65) AS bit,
            coalesce(list_sum(list_transform(range(1, k), lambda j: 1 << (ascii(filter_order[j]) - 65))), 0)::int AS before
        FROM (SELECT filter_order, unnest(range(1, 6)) AS k FROM orders)),
    counted AS (
        SELECT part, filter_order, step, bit,
            coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::bigint AS kept,
            coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit > 0), 0)::bigint AS removed,
            coalesce(sum(n) FILTER (mask & before > 0 AND mask & bit > 0), 0)::bigint AS redundant,
            coalesce(sum(n) FILTER (mask = bit), 0)::bigint AS unique_fails,
            coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit > 0), 0)::bigint AS good_lost,
            coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit > 0), 0)::bigint AS toxic_lost
        FROM cells, steps GROUP BY part, filter_order, step, bit, before)
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
        (sum(removed) OVER (PARTITION BY part, bit))::bigint AS shapley FROM counted""",
)
def op11(spark, folder):
    docs, marks = table(spark, folder, "documents"), {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    failed = audit.failed_sets(docs, audit.text_rules(F.coalesce("text", F.lit(""))))
    rows = audit.with_labels(failed, table(spark, folder, "labels"), marks)
    return audit.by_order(audit.edges(rows, FILTERS, list(marks)), FILTERS, list(marks))


def _license_sql() -> str:
    """The templates' grams as rows, joined to the grams of all texts."""
    templates = [*licenses.PHRASES, *licenses.NOTICES]
    rows = ", ".join(f"({i}, '{label}', '{phrase}', {licenses.gram_size(phrase.split())}, {str(i < len(licenses.PHRASES)).lower()})" for i, (label, phrase) in enumerate(templates))
    return f"""WITH t AS (SELECT *, string_split(phrase, ' ') AS tw FROM (VALUES {rows}) v(template, label, phrase, size, base)),
    grams AS (SELECT template, size, j, array_to_string(tw[j + 1 : j + size], ' ') AS gram FROM (SELECT *, unnest(range(len(tw) - size + 1)) AS j FROM t)),
    d AS (SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
    places AS (SELECT r, w, size, unnest(range(len(w) - size + 1)) AS i FROM d, (SELECT DISTINCT size FROM t)),
    votes AS (SELECT r, template, i, j, i - j AS diagonal FROM places p JOIN grams g ON g.size = p.size AND g.gram = array_to_string(p.w[i + 1 : i + p.size], ' ')),
    steps AS (SELECT *, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) > 3, false)::int AS apart FROM (SELECT DISTINCT r, template, diagonal FROM votes)),
    merged AS (SELECT r, template, diagonal, CASE WHEN base THEN diagonal ELSE sum(apart) OVER (PARTITION BY r, template ORDER BY diagonal) END AS span FROM steps JOIN t USING (template)),
    spans AS (
        SELECT r, template, base, label, min(i) AS first, len(list_distinct(flatten(list(range(j, j + size))))) / greatest(len(any_value(tw)), max(i) - min(i) + any_value(size)) AS share
        FROM votes JOIN merged USING (r, template, diagonal) JOIN t USING (template) GROUP BY r, template, base, label, span),
    found AS (
        SELECT r, count(*) FILTER (base AND share = 1) AS n_base, min(first) FILTER (base AND share = 1) AS first_word, max(first) FILTER (base AND share = 1) AS last_word,
            string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND share = 1) AS base_labels,
            string_agg(DISTINCT label, ',' ORDER BY label) FILTER ((base AND share = 1) OR (NOT base AND share >= 0.8)) AS labels, max(share) AS score
        FROM spans GROUP BY r)
    SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_base, 0)::bigint AS n_base, first_word::bigint AS first_word, last_word::bigint AS last_word,
        coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::double AS score FROM d LEFT JOIN found USING (r)"""


@query("op13_license_scan", _license_sql())
def op13(spark, folder):
    return licenses.scan(table(spark, folder, "documents"))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given another role by a hash of their conversation and turn."""
    filled = rows.select("conv_id", "turn", repair.null_as_space(F.col("role")).alias("role"), repair.null_as_space(F.col("text")).alias("text"))
    key = F.concat(repair.null_as_space(F.col("conv_id")), F.lit(":"), repair.null_as_space(F.col("turn")))
    marked = filled.withColumn("_how", F.crc32(key) % 20).where("_how <> 0")
    text = F.when(F.col("_how") == 1, "").when(F.col("_how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_how") == 4, "user").otherwise(F.col("role"))
    twice = F.explode(F.when(F.col("_how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return marked.select("conv_id", "turn", role.alias("role"), text.alias("text"), twice.alias("_copy")).drop("_copy")


@query("op12_conversation_repair")
def op12(spark, folder):
    rows = table(spark, folder, "conversations")
    summary, turns = repair.repair(damaged(rows))
    found = summary.join(repair.digests(turns).withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    ids = rows.select(F.col("conv_id").alias("_id")).distinct()
    all_ids = ids.join(found, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    sha = F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return all_ids.select(F.col("_id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), sha)
