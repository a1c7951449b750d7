"""Substring deduplication by sliding spans of sentences.

A sentence is a run without ``. ! ?`` or line end, with the marks and white space that follow it; joining all sentences gives
the text back. Every run of ``span`` consecutive sentences is hashed (two 64-bit hashes of the trimmed sentences); all
runs of all documents are grouped by hash. The first run, by document id and place, stays; the sentences of every later
equal run go, wherever it stands.

* Null text or empty text: no sentence, nothing removed, kept text null or empty.
* Fewer sentences than ``span``: the whole text is one run of its own length.
* Runs under ``min_chars`` characters never count as repeats: chance meetings of very short sentences stay.
* Ties: rows with one id count as one document; wholly equal rows keep the same sentences. Null ids order last.
* Other columns are not carried. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackstand.llm.common import narrow, row_key

SENTENCE = r"[^.!?\n]+[.!? \t\n\r]*|[.!? \t\n\r]+"
SPAN, MIN_CHARS = 3, 60
LAST_ID = 2**63 - 1


def _split(df: DataFrame) -> DataFrame:
    sentences = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(SENTENCE), F.lit(0))
    return df.select("doc_id", "text", row_key().alias("row"), sentences.alias("s"))


def spans(df: DataFrame, span: int = SPAN, min_chars: int = MIN_CHARS) -> DataFrame:
    """row, place (document id and sentence number as one ordered number), i, h1, h2 of every run."""
    last = F.greatest(F.lit(0), F.size("s") - span)
    # runs are built inside the array, so that exploding copies a run and not the whole text for every sentence
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.concat_ws("\x01", *[F.trim(F.get("s", i + k), F.lit(" \t\n\r")) for k in range(span)]))
    place = F.coalesce("doc_id", F.lit(LAST_ID)).cast("decimal(20,0)") * F.lit(2**31).cast("decimal(10,0)") + F.col("i")
    return (
        df.select("doc_id", "row", F.posexplode(runs).alias("i", "run"))
        .where(F.length("run") >= min_chars)
        .select("row", place.cast("decimal(38,0)").alias("place"), "i", F.xxhash64("run").alias("h1"), F.xxhash64(F.lit(17), "run").alias("h2"))
    )


def drop_repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, n_sentences, n_removed, kept_text for every row of ``df``."""
    docs = _split(narrow(df, id_col, text_col))
    runs = spans(docs, span, min_chars)
    # counts combine before the shuffle, so a run that a third of all documents share is a few rows per task
    firsts = runs.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = runs.join(firsts, ["h1", "h2"]).where(F.col("place") > F.col("first"))
    gone = later.groupBy("row").agg(F.array_distinct(F.flatten(F.collect_set(F.sequence("i", F.col("i") + span - 1)))).alias("gone"))
    left = F.array_except(F.sequence(F.lit(0), F.size("s") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get("s", i)), ""))
    return docs.join(gone, "row", "left").select(
        "doc_id",
        F.size("s").cast("long").alias("n_sentences"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("s") - F.size(left)).cast("long").alias("n_removed"),
        kept.alias("kept_text"),
    )


def sql(span: int = SPAN, min_chars: int = MIN_CHARS) -> str:
    parts = ", ".join(f"trim(s[i + {k}], e' \\t\\n\\r')" for k in range(1, span + 1))
    return f"""
with docs as (select row_number() over () as r, doc_id, text,
         regexp_extract_all(coalesce(text, ''), e'[^.!?\\n]+[.!? \\t\\n\\r]*|[.!? \\t\\n\\r]+') as s from documents),
     places as (select r, doc_id, s, unnest(range(len(s))) as i from docs),
     runs as (select r, coalesce(doc_id, {LAST_ID}) as d, i, concat_ws(chr(1), {parts}) as run from places
              where i <= len(s) - {span} or i = 0),
     long as (select * from runs where length(run) >= {min_chars}),
     ranked as (select r, i, row_number() over (partition by run order by d, i, r) > 1
                       and (d, i) <> first_value((d, i)) over (partition by run order by d, i, r) as later from long),
     gone as (select distinct r, j from (select r, unnest(range(i, i + {span})) as j from ranked where later)),
     kept as (select p.r, string_agg(p.s[p.i + 1], '' order by p.i) as kept_text from places p
              left join gone g on g.r = p.r and g.j = p.i where g.r is null group by p.r),
     lost as (select g.r, count(*) as n from gone g join docs d on d.r = g.r where g.j < len(d.s) group by g.r)
select doc_id, cast(len(s) as bigint) as n_sentences, cast(coalesce(n, 0) as bigint) as n_removed,
       case when n is null then text else coalesce(kept_text, '') end as kept_text
from docs left join kept using (r) left join lost using (r)
"""
