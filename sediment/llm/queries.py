"""One query per operator, over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm import (
    decontaminate,
    language,
    license_vote,
    line_windows,
    pca_tiles,
    periodic_runs,
    pivotal,
    quality,
    separator_scan,
    simhash,
    square_packing,
    token_alignment,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_warc(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    folder = warc.archive_folder(pages)
    found = warc.read(folder, warc.write(pages, folder))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op1_warc"] = """
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
r as (select *, row_number() over (partition by h order by page_id) as nth, min(page_id) over (partition by h) as first from p)
select page_id, strlen(html)::bigint as payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (((('0x' || substr(h, (5 * (i // 4) + 1)::int, 5))::bigint >> (15 - 5 * (i % 4))::int) & 31) + 1)::int, 1)),
           'string_agg', '') as payload_digest,
       case when nth = 1 then 'response' else 'revisit' end as record_type,
       case when nth > 1 then first end as refers_to
from r
"""


@query
def op2_token_counts(spark, sf_dir):
    counted = separator_scan.count(_table(spark, sf_dir, "documents"))
    return counted.select(F.col("_id").alias("doc_id"), "n_tokens")


@query
def op3_simhash(spark, sf_dir):
    grouped = simhash.groups(_table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return grouped.select(F.col("_id").alias("doc_id"), digits.alias("fingerprint"), "component_id")


@query
def op4_decontamination(spark, sf_dir):
    found = decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    names = {"_id": "doc_id", "_item": "item_id"}
    return found.drop("_hash").withColumnsRenamed(names)


@query
def op5_line_windows(spark, sf_dir):
    done = line_windows.deduplicate(_table(spark, sf_dir, "documents"))
    return done.select(
        "doc.doc_id",
        F.length("doc.text").cast("long").alias("kept_chars"),
        "removed",
        F.md5(F.col("doc.text").cast("binary")).alias("text_md5"),
    )


ORACLE["op5_line_windows"] = r"""
with d as (select doc_id, string_split(text, chr(10)) as ls from documents),
lines as (select doc_id, unnest(range(len(ls))) as ln, unnest(ls) as line from d),
bare as (select *, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') as b from lines),
w as (select doc_id, ln as start, lead(ln, 2) over (partition by doc_id order by ln) as stop,
             b || chr(10) || lead(b) over (partition by doc_id order by ln)
               || chr(10) || lead(b, 2) over (partition by doc_id order by ln) as words
      from bare where b <> ''),
n as (select *, row_number() over (partition by words order by doc_id, start) as nth from w where stop is not null),
gone as (select distinct b.doc_id, b.ln from bare b join n on n.doc_id = b.doc_id and b.ln between n.start and n.stop and n.nth > 1),
kept as (select b.doc_id, coalesce(string_agg(b.line, chr(10) order by b.ln) filter (g.ln is null), '') as text,
                count(*) filter (g.ln is not null and b.b <> '') as removed
         from bare b left join gone g using (doc_id, ln) group by b.doc_id)
select d.doc_id, length(k.text)::bigint as kept_chars, coalesce(k.removed, 0)::bigint as removed, md5(k.text) as text_md5
from d left join kept k using (doc_id)
"""


@query
def op6_embeddings(spark, sf_dir):
    return pca_tiles.neighbours(_table(spark, sf_dir, "embeddings"))


ORACLE["op6_embeddings"] = """
with recursive v as (select vec_id, embedding::double[] as e from embeddings),
ok as (select * from v where len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
links as (select a.vec_id as x, b.vec_id as y from ok a join ok b
          on a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.95),
reach as (select vec_id as x, vec_id as y from v union select r.x, l.y from reach r join links l on r.y = l.x),
c as (select x, min(y) as component_id from reach group by x),
n as (select x, count(*) as n_links from links group by x)
select v.vec_id, coalesce(n.n_links, 0)::bigint as n_links, c.component_id, v.vec_id = c.component_id as kept
from v join c on v.vec_id = c.x left join n on v.vec_id = n.x
"""


@query
def op7_licenses(spark, sf_dir):
    found = license_vote.licenses(_table(spark, sf_dir, "documents"))
    return found.drop("_hash").withColumnRenamed("_id", "doc_id")


@query
def op8_language(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    found = language.identify(docs, language.learn(docs))
    return found.select(F.col("_id").alias("doc_id"), language.held_out(F.col("_id")).alias("held_out"), "lang_pred", "score")


@query
def op9_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    graded = quality.grade(docs, quality.learn(docs, _table(spark, sf_dir, "labels")))
    return graded.drop("_hash").withColumnRenamed("_id", "doc_id")


@query
def op10_mixing(spark, sf_dir):
    mixed = pivotal.mix(_table(spark, sf_dir, "documents"))
    return mixed.select(F.col("_id").alias("doc_id"), "source", "size", "source_size", "target", "copies", "taken")


def repeated(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, a tenth of the texts, picked by a checksum of the id, made to repeat towards their end.

    Of ``n`` words those from ``a`` on are replaced by the first ``p`` of them, over and
    over. The other texts stay as they are.
    """
    checksum = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.select("doc_id", "text", checksum.alias("h"), F.floor(checksum / 10).alias("g"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    marked = chosen.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("words"))
    n = F.greatest(F.col("n"), F.lit(1))
    placed = marked.withColumn("a", (F.col("g") % n).cast("int"))
    period = 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))
    placed = placed.withColumn("p", period.cast("int"))
    head = F.slice("words", F.lit(1), F.col("a"))
    block = F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(block, times)), F.lit(1), n - F.col("a"))
    made = F.array_join(F.concat(head, tail), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs.runs(repeated(_table(spark, sf_dir, "documents")))
    best = periodic_runs.strongest("runs")
    line = F.transform("runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    lines = F.array_join(F.transform(line, lambda text: F.concat(text, F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        F.col("_id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")],
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_packing(spark, sf_dir):
    packed = square_packing.pack(_table(spark, sf_dir, "documents"))
    return packed.select(
        F.col("_id").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query
def op13_alignment(spark, sf_dir):
    linked = token_alignment.link_counts(_table(spark, sf_dir, "documents"))
    return linked.select(
        F.col("_id").alias("doc_id"),
        *["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"],
        F.when(F.col("n_a") == 0, F.lit("")).otherwise(F.sha2("groups", 256)).alias("groups_sha256"),
    )
