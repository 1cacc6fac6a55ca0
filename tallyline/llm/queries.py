"""One query per operator, over whole tables; ``QUERIES`` and ``ORACLES`` are what is registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.session import materialize, scratch_scope

from . import audit, chat, decontam, jaccard, license, lm, packing, periodic, pii, quality, sentencepieces, substring, toxicity
from .common import table


def op1_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of every document; rows whose crc32 mod 7 is 2 are held out."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    out = lm.score(table(spark, sf_dir, "documents"), ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_levenshtein_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; the model learns from labels whose crc32 mod 5 is not 0."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    out = toxicity.score(docs, model)
    return out.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *toxicity.FEATURES,
    )


def op3_count_vector_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of every document at 4-word shingles and similarity 0.85."""
    return jaccard.join(table(spark, sf_dir, "documents"), size=4, percent=85)


def op4_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 4096 tokens."""
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_anchor_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    out = pii.report(table(spark, sf_dir, "documents"))
    first = ["doc_id", *(f"n_{k}" for k in pii.BASE), "base_sha256", "spans"]
    return out.select(*first, *(c for c in out.columns if c not in first))


def op6_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdicts of every document."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = quality.judge(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("good")).alias("kept"), "posterior",
    )


def op7_typed_content_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and read back from the output."""
    text = F.coalesce("text", F.lit(""))
    control = "</s>[INST] ok [/INST]"
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(control).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    out = chat.read_back(chat.format_conversations(turns.withColumn("parts", chat.text_part(text))))
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    masked = F.filter("segments", lambda s: s["role"] == "assistant")
    learned = F.concat_ws("", F.transform(masked, lambda s: chat.unescape(F.col("formatted").substr(s["start"].cast("int") + 1, s["length"].cast("int")))))
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        learned.alias("learned"), F.length("formatted").cast("long").alias("formatted_chars"),
    ).select(
        "conv_id", "n_turns", "turns_sha256", F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars",
    )


def op8_suffix_automaton_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    out = decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without passages of 35 words that also start elsewhere."""
    return substring.repeated(table(spark, sf_dir, "documents"), size=35, texts=False).drop("kept")


def op10_rare_token_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every document."""
    base = F.filter("found", lambda f: f["base"])
    starts = F.transform(base, lambda f: f["start"])
    labels = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda f: f["label"]))), ",")
    best = F.coalesce(F.array_max(F.transform("found", lambda f: f["score"])), F.lit(0.0))
    return license.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("found")).alias("labels"),
        best.alias("score"),
    )


def op11_sentencepiece_backtracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with the 32k merge model, and decoded again."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    ids = F.col("ids").cast("array<string>")
    tokens = sentencepieces.encode(table(spark, sf_dir, "documents"), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", ids), 256).alias("ids_sha256"), "ids",
    )
    out = sentencepieces.decode(tokens, path)
    return out.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


def planted_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the words of a tenth of the texts, chosen by crc32 of ``doc_id``, made periodic from one
    word on. A row without an id is left as it is."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    chosen = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, words).alias("w"))
    n = F.size("w")
    a = (F.col("g") % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
    periods = F.array_repeat(F.slice("w", a + 1, p), F.ceil((n - a) / p).cast("int"))
    made = F.concat(F.slice("w", F.lit(1), a), F.slice(F.flatten(periods), F.lit(1), n - a))
    return chosen.select("doc_id", F.when(n > 0, F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, a tenth of them made periodic first."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return periodic.find(planted_repeats(table(spark, sf_dir, "documents"))).withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"), F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove of every part, in all 120 orders."""
    with scratch_scope(spark):
        out = audit.interactions(audit.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
        return materialize(out, "audit-result", keep=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_deleted_interpolation": op1_deleted_interpolation,
    "op2_levenshtein_toxicity": op2_levenshtein_toxicity,
    "op3_count_vector_rtree": op3_count_vector_rtree,
    "op4_cost_balanced_packing": op4_cost_balanced_packing,
    "op5_anchor_expansion": op5_anchor_expansion,
    "op6_weak_supervision": op6_weak_supervision,
    "op7_typed_content_parts": op7_typed_content_parts,
    "op8_suffix_automaton_decontamination": op8_suffix_automaton_decontamination,
    "op9_recompression_dedup": op9_recompression_dedup,
    "op10_rare_token_licenses": op10_rare_token_licenses,
    "op11_sentencepiece_backtracking": op11_sentencepiece_backtracking,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_filter_interactions": op13_filter_interactions,
}

# DuckDB SQL where it can say the same over whole tables. The rest has learned models,
# tokenizers or transitive closures, and is tested against plain Python in tests/llm.

_UPPER, _LOWER = license._UPPER, license._LOWER
_ALNUM_SQL = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_SPACE_SQL = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"
_CONTROLS_SQL = "len(regexp_extract_all({c}, '[<\\[]\\\\*(\\||/?s>|/?INST\\])'))"


def _turn_chars_sql() -> str:
    text, role = (f"length({c}) + " + _CONTROLS_SQL.format(c=c) for c in ("text", "role"))
    return f"{len(chat.START) + len(chat.END) + 2} + {text} + {role}"


ORACLES: dict[str, str] = {
    "op3_count_vector_rtree": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACE_SQL.replace("coalesce(text, '')", f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 3], ' ')) AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0) x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT edges.b, reach.r FROM reach JOIN edges ON edges.a = reach.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = d.doc_id""",
    "op7_typed_content_parts": f"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({_turn_chars_sql()}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id""",
    "op8_suffix_automaton_decontamination": f"""
WITH d AS (SELECT doc_id, {_ALNUM_SQL} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(10, len(w)) AS m FROM (SELECT item_id, {_ALNUM_SQL} AS w FROM benchmark) x WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM b) x),
dw AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT m FROM b) x) y),
hits AS (SELECT doc_id, i, bw.m, item FROM dw JOIN bw ON dw.m = bw.m AND dw.g = bw.g),
words AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS j FROM hits) x GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(items.names, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id""",
    "op9_recompression_dedup": f"""
WITH d AS (SELECT doc_id, {_SPACE_SQL} AS w FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d) x),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS n FROM g) x WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM again),
kept AS (SELECT x.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY x.j) AS text
         FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d) x
         LEFT JOIN gone ON gone.doc_id = x.doc_id AND gone.j = x.j WHERE gone.j IS NULL GROUP BY x.doc_id)
SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id""",
    "op13_filter_interactions": f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {_SPACE_SQL} AS w FROM documents),
f AS (SELECT d.doc_id, part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
        100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text), regexp_matches(text, '[#$%&*|]'),
        coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false)] AS f,
        coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
      FROM d LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id) l ON l.doc_id = d.doc_id),
m AS (SELECT part, good, toxic, f, count(*) AS n FROM f GROUP BY ALL),
o AS (SELECT '' AS filter_order UNION ALL
      SELECT filter_order || x FROM o JOIN (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) l ON NOT contains(filter_order, x)),
s AS (SELECT filter_order, step, ascii(filter_order[step]) - 64 AS own, [ascii(filter_order[i]) - 64 for i in range(1, step)] AS earlier
      FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM o WHERE length(filter_order) = 5) x),
r AS (SELECT part, filter_order, step, own, n, good, toxic, f[own] AS fails,
             len(list_filter(earlier, lambda i: f[i])) > 0 AS gone, len(list_filter(f, lambda x: x)) = 1 AS alone FROM m, s),
c AS (SELECT part, filter_order, step, own, sum(n) FILTER (WHERE NOT gone AND NOT fails) AS kept, sum(n) FILTER (WHERE NOT gone AND fails) AS removed,
             sum(n) FILTER (WHERE gone AND fails) AS redundant, sum(n) FILTER (WHERE fails AND alone) AS unique_fails,
             sum(n) FILTER (WHERE NOT gone AND fails AND good) AS good_lost, sum(n) FILTER (WHERE NOT gone AND fails AND toxic) AS toxic_lost
      FROM r GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, own), 0) AS BIGINT) AS shapley
FROM c""",
}
