"""Benchmark decontamination by spaced seeds: DataFrame functions only.

Words are lower-cased (A-Z) and cut at ASCII white space. Each fixed mask says which words of a window count; the window's
hash skips the others, so a changed word under a gap does no harm. All masks count both ends of a window; the pair of ends is looked up
first, and only windows whose ends stand in the benchmark are hashed by the masks. Hashes of all windows of all documents meet those of
the benchmark; around each hit the benchmark window of up to ``WINDOW`` words is laid beside the document, and the pair
stands if at least ``SHARE`` per cent of its words are equal in place.

* Null or empty text, or fewer words than a mask is long: no hit. The same for benchmark items.
* Repeated rows and ids: one output row per id and item. Null document ids form one group, null item ids another.
* Other columns are not carried. Either table empty: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackstand.llm.common import free_name, if_small, narrow, row_key, store

#: Fixed seeds: which of nine words count. Six of nine, no two with the same gaps.
MASKS = ("110110011", "101011011", "111001101")
REACH = len(MASKS[0])
WINDOW, SHARE = 13, 75
#: Seeds that one broadcast holds (about 100 bytes each, with their words); more go in further passes.
SEEDS_PER_PASS = 400_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = " \t\n\x0b\f\r"


def _words(text: str) -> Column:
    return F.split(F.trim(F.translate(text, UPPER, LOWER), F.lit(SPACES)), "[ \\t-\\r]+")


def _windows(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row per window: ``keep``, h (hashes of all words), pos, pair (hash of the window's two ends, which every mask counts).

    Windows are made inside an array; exploding copies numbers, and h goes along by reference up to the next join. The outer form keeps
    Spark from testing the array for emptiness first, which would make it twice; a text without a window has one row without a pair.
    """
    hashed = df.select(*keep, F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    ends = F.zip_with(F.slice("h", 1, F.greatest(F.size("h") - (REACH - 1), F.lit(0))), F.slice("h", REACH, F.size("h")), lambda a, b: F.xxhash64(a, b))
    return hashed.select(*keep, "h", ends.alias("ends")).select(*keep, "h", F.posexplode_outer("ends").alias("pos", "pair"))


def _seeds(windows: DataFrame, keep: list[str]) -> DataFrame:
    """One row per mask and window: ``keep``, pos, pair, seed."""
    seeds = F.array(*[F.xxhash64(F.lit(m), *[F.get("h", F.col("pos") + k) for k, c in enumerate(mask) if c == "1"]) for m, mask in enumerate(MASKS)])
    return windows.select(*keep, "pos", "pair", seeds.alias("seeds")).select(*keep, "pos", "pair", F.explode_outer("seeds").alias("seed"))


def seed_table(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """seed, pair, item_id, ahead (words of the window before the hit), window (its words)."""
    items = narrow(benchmark, item_col, text_col).select(F.col("doc_id").alias("item_id"), _words("text").alias("words"))
    length = F.least(F.size("words"), F.lit(WINDOW))
    begin = F.greatest(F.lit(0), F.least(F.col("pos") - F.lit((WINDOW - REACH) // 2), F.size("words") - length))
    return _seeds(_windows(items, ["item_id", "words"]), ["item_id", "words"]).select("seed", "pair", "item_id", (F.col("pos") - begin).alias("ahead"), F.slice("words", begin + 1, length).alias("window"))


def verified_hits(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", share: int = SHARE, seeds_per_pass: int = SEEDS_PER_PASS) -> DataFrame:
    """row, doc_id, item_id, pos, m (equal words), w (words of the window) of every hit that stands.

    Hits are written before they are verified, so that of all texts only those with a hit are cut into words again and shuffled.
    """
    texts = narrow(df, id_col, text_col).select(row_key().alias("row"), "doc_id", "text")
    seeds = seed_table(benchmark, item_col, item_text_col)
    passes = max(1, -(-seeds.count() // seeds_per_pass))
    windows = _windows(texts.select("row", _words("text").alias("words")), ["row"])
    hits = None
    for k in range(passes):  # each broadcast is bounded; a larger benchmark takes more passes, not more memory
        part = seeds.where(F.pmod("seed", F.lit(passes)) == k) if passes > 1 else seeds
        # a window whose ends the benchmark does not have can match under no mask, so only the others are hashed by the masks
        met = windows.join(F.broadcast(part.select("pair").distinct()), "pair")
        found = _seeds(met, ["row"]).drop("pair").join(F.broadcast(part.drop("pair")), "seed")
        hits = found if hits is None else hits.unionByName(found)
    # a row's hits are bounded by its own words and its windows' occurrences in the benchmark
    hits = store(hits.groupBy("row").agg(F.collect_set(F.struct("pos", "item_id", "ahead", "window")).alias("hits")), "hits")
    docs = texts.join(if_small(hits.select("row")), "row", "left_semi").select("row", "doc_id", _words("text").alias("words"))

    def equal_words(h):
        same = F.transform(h["window"], lambda word, j: F.get("words", h["pos"] - h["ahead"] + j) == word)
        return F.struct(h["item_id"].alias("item_id"), h["pos"].alias("pos"), F.size(F.filter(same, lambda x: x)).alias("m"), F.size(h["window"]).alias("w"))

    checked = docs.join(hits, "row").select("row", "doc_id", F.transform("hits", equal_words).alias("hits"))
    stands = F.filter("hits", lambda h: h["m"] * 100 >= h["w"] * share)
    return checked.select("row", "doc_id", F.inline(stands))


def contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, item_id, matched (most equal words in a window), window_words, first_word (first hit's word number)."""
    hits = verified_hits(df, benchmark, id_col, text_col, **options)
    return hits.groupBy("doc_id", "item_id").agg(
        F.max("m").cast("long").alias("matched"), F.max("w").cast("long").alias("window_words"), F.min("pos").cast("long").alias("first_word"))


def drop_contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without the rows whose text overlaps a benchmark item; all its columns stay.

    Rows are told apart by id and text, so a clean row that shares an id with a contaminated one stays.
    """
    key = row_key(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`"))
    hit = free_name(df, "hit")
    bad = store(verified_hits(df, benchmark, id_col, text_col).select(F.col("row").alias(hit)).distinct(), "contaminated")
    return df.join(if_small(bad), key == F.col(hit), "left_anti")


def sql(share: int = SHARE) -> str:
    """The same on DuckDB: seeds are the words themselves."""
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^ \\t-\\r]+')"
    seed = " union all ".join(
        f"select *, concat_ws(' ', '{m}', " + ", ".join(f"w[pos + {k + 1}]" for k, c in enumerate(mask) if c == "1") + ") as seed from {}"
        for m, mask in enumerate(MASKS))
    return f"""
with d as (select doc_id, {words} as w from documents), b as (select item_id, {words} as w from benchmark),
     dp as (select doc_id, w, unnest(range(len(w) - {REACH - 1})) as pos from d where len(w) >= {REACH}),
     bp as (select item_id, w, unnest(range(len(w) - {REACH - 1})) as pos from b where len(w) >= {REACH}),
     ds as ({seed.format(*["dp"] * len(MASKS))}), bs as ({seed.format(*["bp"] * len(MASKS))}),
     bw as (select *, greatest(0, least(pos - {(WINDOW - REACH) // 2}, len(w) - least(len(w), {WINDOW}))) as bg, least(len(w), {WINDOW}) as wl from bs),
     hit as (select ds.doc_id, bw.item_id, ds.pos, wl,
               len(list_filter(range(wl), lambda j: ds.pos - (bw.pos - bg) + j >= 0 and coalesce(ds.w[ds.pos - (bw.pos - bg) + j + 1] = bw.w[bg + j + 1], false))) as m
             from ds join bw using (seed))
select doc_id, item_id, cast(max(m) as bigint) as matched, cast(max(wl) as bigint) as window_words, cast(min(pos) as bigint) as first_word
from hit where m * 100 >= wl * {share} group by doc_id, item_id
"""
