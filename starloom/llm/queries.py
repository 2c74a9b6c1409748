"""The registered queries of the operators, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    divergence,
    jaccard_join,
    language_id,
    line_dedup,
    mixing,
    periodic_runs,
    pitman_yor,
    quality_fm,
    quality_rules,
    suffix_dedup,
    url_filter,
    warc,
    winnowing,
)
from starloom.llm.native import let, words_of

Runner = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Runner] = {}
SQL: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Runner], Runner]:
    def put(run: Runner) -> Runner:
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return put


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def remainder(modulus: int) -> Column:
    """What the id, as text, leaves by CRC-32; null ids leave none."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


@register()
def op1_language_id(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "lang", "text")
    model = language_id.fit(docs, learn=remainder(3) != 1)
    predicted = language_id.predict(docs, model, keep=["doc_id"]).select("row.doc_id", "lang_pred", "score", "second", "ambiguous")
    return predicted.withColumn("held_out", F.coalesce(remainder(3) == 1, F.lit(False)))


@register()
def op2_warc(spark, sf):
    pages = read(spark, sf, "pages")
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("string").alias("id"), "url", payload.alias("payload"))
    columns = ["id", "record_id", "record_type", "payload_bytes", "payload_digest", "refers_to"]
    back = warc.round_trip(rows, order=lambda c: c.cast("long"), columns=columns, version=2)
    ids = [F.col("id").cast("long").alias("page_id"), F.col("refers_to").cast("long").alias("refers_to")]
    return back.select(*ids, "payload_bytes", "payload_digest", "record_type", "record_id")


@register()
def op3_quality_fm(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text", "n_chars")
    machine = quality_fm.fit(docs, read(spark, sf, "labels"), learn=remainder(4) != 2, meta="n_chars")
    scored = quality_fm.score(docs, machine, keep=["doc_id"], meta="n_chars").select("row.doc_id", "score")
    held_out = F.coalesce(remainder(4) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


# The rules of the query, as (verdict, host, path).
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


@register()
def op4_url_filter(spark, sf):
    rules = [url_filter.host_rule(*r) for r in URL_RULES]
    judged = url_filter.judge_urls(read(spark, sf, "pages").select("page_id", "url"), rules)
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


@register()
def op5_pitman_yor(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    model = pitman_yor.fit(docs.filter(remainder(10) != 0))
    scored = pitman_yor.score(docs, model)
    extra = {
        "held_out": F.coalesce(remainder(10) == 0, F.lit(False)),
        "train_tokens": F.lit(model.tokens).cast("long"),
        "perplexity": F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")),
    }
    return scored.withColumns(extra)


@register()
def op6_quality_rules(spark, sf):
    judged = quality_rules.judge(read(spark, sf, "documents"), keep=["doc_id"])
    failed = quality_rules.base_failed()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(
        "row.doc_id",
        *[f"stats.{n}" for n in names],
        failed.alias("base_failed"),
        (~failed & F.col("good")).alias("kept"),
        "quality",
    )


@register()
def op7_suffix_dedup(spark, sf):
    found = suffix_dedup.repeats(read(spark, sf, "documents").select("doc_id", "text"), keep=["doc_id"])
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@register()
def op8_mixing(spark, sf):
    mixed = mixing.mix(read(spark, sf, "documents").select("doc_id", "source", "text"), keep=["doc_id"])
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("row.doc_id", "size", "source_size", "target", taken)


@register()
def op9_winnowing(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    hits = winnowing.find_hits(docs, read(spark, sf, "benchmark"), keep=["doc_id"])
    return hits.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@register()
def op10_jaccard_join(spark, sf):
    linked = jaccard_join.link(read(spark, sf, "documents").select("doc_id", "text"))
    return linked.select("doc_id", "n_shingles", "component_id", "cls")


def with_planted_period(words: Column, h: Column) -> Column:
    """The words of a text; where the hash ends in 0, those from a place on repeat with a period, both named by the hash."""
    g = F.floor(h / 10)
    n = F.size(words)
    start = g % n
    period = 1 + F.floor((n - start) / (3 + g % 8))
    again = F.slice(words, start.cast("int") + 1, period.cast("int"))
    times = F.ceil((n - start) / period).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(again, times)), F.lit(1), (n - start).cast("int"))
    return F.when((h % 10 == 0) & (n > 0), F.concat(F.slice(words, F.lit(1), start.cast("int")), tail)).otherwise(words)


@register()
def op11_periodic_runs(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    planted = F.array_join(let(words_of(F.col("text")), lambda w: with_planted_period(w, h)), " ")
    docs = docs.withColumn("text", F.when(h % 10 == 0, planted).otherwise(F.col("text")))
    found = periodic_runs.runs_of(docs, keep=["doc_id"])
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    told = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.select("row.doc_id", "runs", "collapsed", longest.alias("longest"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.s")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.p")).alias("period"),
        F.expr("1000 * longest.length div -longest.p").alias("exponent_milli"),
        F.sha2(F.array_join(told, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@register(
    """
    WITH lines AS (
        SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
    ),
    keyed AS (
        SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM lines
    ),
    repeated AS (
        SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT doc_id) >= 3
    ),
    judged AS (SELECT k.*, coalesce(k.doc_id <> r.holder, false) AS gone FROM keyed k LEFT JOIN repeated r USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY doc_id
    """
)
def op12_line_dedup(spark, sf):
    found = line_dedup.dedup_lines(read(spark, sf, "documents").select("doc_id", "text"), keep=["doc_id"])
    return found.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@register(
    r"""
    WITH docs AS (
        SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents
    ),
    words AS (SELECT k, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
    kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT k) >= 3),
    cells AS (SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    groups AS (SELECT DISTINCT lang, source FROM docs),
    sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
    totals AS (SELECT lang, source, sum(c)::HUGEINT AS n FROM cells GROUP BY lang, source),
    wholes AS (SELECT lang, sum(c)::HUGEINT AS n FROM cells GROUP BY lang),
    shares AS (
        SELECT g.lang, g.source, kept.term, coalesce(c, 0) AS c,
               1 + (1000000000::HUGEINT * (coalesce(c, 0) + 1)) // (coalesce(t.n, 0) + v) AS p
        FROM groups g JOIN kept USING (lang) JOIN sizes USING (lang)
        LEFT JOIN totals t USING (lang, source) LEFT JOIN cells ON cells.lang = g.lang AND cells.source = g.source AND cells.term = kept.term
    ),
    whole AS (
        SELECT cells.lang, cells.term, 1 + (1000000000::HUGEINT * (sum(c)::HUGEINT + 1)) // (any_value(w.n) + any_value(v)) AS q
        FROM cells JOIN sizes USING (lang) JOIN wholes w USING (lang) GROUP BY cells.lang, cells.term
    ),
    pairs AS (
        SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ),
    found AS (
        SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value
        FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
        LEFT JOIN pairs ON pairs.lang = g.lang AND pairs.source = g.source AND pairs.item = h.source
        UNION ALL
        SELECT s.lang, s.source, 'term', s.term, ((p - q) * (p - q)) // q FROM shares s JOIN whole USING (lang, term) WHERE c > 0 AND p > q
    )
    SELECT lang, source, part, item, value::BIGINT AS value,
           row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
    FROM found QUALIFY part = 'pair' OR rank <= 200
    """
)
def op13_divergence(spark, sf):
    return divergence.audit(read(spark, sf, "documents"))
