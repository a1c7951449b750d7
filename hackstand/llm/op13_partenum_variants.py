"""Spelling variants: words one letter apart, found by partition and enumeration of their letter multisets.

A word's letters with their repeats are a binary vector (letter, how manieth). One inserted or deleted letter changes one place of
it, a replaced letter two. The alphabet is split into ``PARTS`` parts; two vectors at Hamming distance two or less differ in at most two
parts, so they agree on all others. Every multiset has one signature for each choice of two parts to leave out: the letters in the
remaining parts. Equal signatures are joined once per distinct multiset, and words of joined multisets are verified by their edit
distance. The parts are balanced by the letters' frequency among the words; any parts give the same result. All joins are by shuffle: words,
signatures and pairs grow with the input, and their written files look small.

* Null text: no words. A null id: hashed as the empty string. Repeated rows and ids: every occurrence counts.
* Ties between near words of one count go to the smallest in code-point order.
* Other columns are not carried. An empty table gives an empty table.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackstand.llm.common import narrow, store
from hackstand.session import by_shuffle

PARTS = 7
#: Fixed by the contract: words' letters, length and count, and the divisor that picks the occurrences that lose a letter.
RUN, LEAST_LENGTH, LEAST_COUNT, EVERY = "[a-z\\u00C0-\\u00FF]+", 5, 3, 97
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = EVERY, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n, letters (the word's sorted letters) of all frequent words. Counts combine before the shuffle."""
    lower = F.translate("text", UPPER, LOWER)
    runs = narrow(df, id_col, text_col).select("doc_id", F.explode(F.regexp_extract_all(lower, F.lit(RUN), F.lit(0))).alias("run"))
    hashed = runs.withColumn("h", F.crc32(F.encode(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")), "UTF-8")))
    place = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), place), F.substr("run", place + 2))
    words = hashed.select(F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least_length)
    counts = words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)
    return counts.withColumn("letters", F.concat_ws("", F.array_sort(F.split("word", ""))))


def alphabet_parts(letters: DataFrame, parts: int = PARTS) -> list[str]:
    """The alphabet dealt into parts of about equal weight: the most frequent letter first, each to the lightest part.

    Reads one row per letter of the alphabet, whatever the number of words.
    """
    weights = letters.select(F.explode(F.split("letters", "")).alias("letter")).groupBy("letter").count().collect()
    out, load = [""] * parts, [0] * parts
    for letter, weight in sorted(((r["letter"], r["count"]) for r in weights), key=lambda x: (-x[1], x[0])):
        k = load.index(min(load))
        out[k] += letter
        load[k] += weight
    return out


def signatures(parts: list[str]) -> Column:
    """One hash for each pair of parts left out, of the letters in the other parts."""
    alphabet = "".join(parts)
    inside = [F.translate("letters", "".join(c for c in alphabet if c not in part), "") for part in parts]
    return F.array(*[F.xxhash64(F.lit(n), *[x for k, x in enumerate(inside) if k not in out]) for n, out in enumerate(combinations(range(len(parts)), 2))])


def close_multisets(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """a, b: pairs of letter multisets (sorted letters, a < b) that share a signature and differ by at most one letter in length."""
    sets = store(words.select("letters").distinct(), "letters")
    signed = sets.select("letters", F.explode(signatures(alphabet_parts(sets, parts))).alias("sign"))
    left, right = (signed.select("sign", F.col("letters").alias(c)) for c in "ab")
    met = left.join(by_shuffle(right), "sign").where((F.col("a") < F.col("b")) & (F.abs(F.length("a") - F.length("b")) <= 1))
    return met.where(F.levenshtein("a", "b", 2) >= 0).select("a", "b").distinct()


def near_words(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """word, n, near, near_n: every ordered pair of words that one inserted, deleted or replaced letter makes equal."""
    pairs = close_multisets(words, parts)
    left, right = (words.select(F.col("letters").alias(c), F.col("word").alias(f"word_{c}"), F.col("n").alias(f"n_{c}")) for c in "ab")
    met = pairs.join(by_shuffle(left), "a").join(by_shuffle(right), "b").where(F.levenshtein("word_a", "word_b", 1) == 1)
    both = F.array(*[F.struct(F.col(f"word_{x}").alias("word"), F.col(f"n_{x}").alias("n"), F.col(f"word_{y}").alias("near"), F.col(f"n_{y}").alias("near_n")) for x, y in ("ab", "ba")])
    return met.select(F.inline(both))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: each word's last form, by doubling: a round replaces every root by that root's own. Counts at least double along forms, so there is no ring."""
    found = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = store(found.join(by_shuffle(further), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not found.where("moved").limit(1).count():
            return found.select("word", "root")


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int = PARTS, **rules) -> DataFrame:
    """word, form, root, n, n_near, form_n of every frequent word."""
    words = store(word_counts(df, id_col, text_col, **rules), "words")
    best = near_words(words, parts).groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    leads = -F.col("best.less") >= 2 * F.col("n")
    best = store(best.select("word", "n_near", F.when(leads, F.col("best.near")).alias("form"), F.when(leads, -F.col("best.less")).alias("form_n")), "forms")
    found = roots(best.where("form is not null"))
    return words.join(by_shuffle(best), "word", "left").join(by_shuffle(found), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def sql() -> str:
    """The same on DuckDB, whose distance is one of bytes: letters beyond ASCII stand as single signs there."""
    beyond = "".join(map(chr, range(0xC0, 0x100)))
    signs = "".join(chr(c) for c in range(0x21, 0x7F) if not 97 <= c <= 122)[: len(beyond)].replace("'", "''")
    digit = "(strpos('0123456789ABCDEF', substr(x, {}, 1)) - 1)"
    return f"""
with recursive steps(i, k, c) as (select i, 0, i from range(256) t(i) union all
         select i, k + 1, case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end from steps where k < 8),
     crc_table as (select list(c order by i) as t from steps where k = 8),
     runs as (select doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) as run from documents),
     own as (select doc_id, run, count(*) as times, hex(encode(doc_id::varchar || ':' || run)) as x from runs group by all),
     hashed as (select run, times, xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
                  list_transform(range(1, length(x), 2), lambda i: (16 * {digit.format('i')} + {digit.format('i + 1')})::bigint)),
                  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]::bigint))) as h from own, crc_table),
     words as (select case when h % {EVERY} = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, times from hashed),
     v as (select word, sum(times)::bigint as n, translate(word, '{beyond}', '{signs}') as s from words where length(word) >= {LEAST_LENGTH} group by word having sum(times) >= {LEAST_COUNT}),
     sized as (select *, unnest([length(s) - 1, length(s), length(s) + 1]) as size from v),
     near as (select a.word, a.n, b.word as near, b.n as near_n from sized a join v b on a.size = length(b.s) where a.word <> b.word and levenshtein(a.s, b.s) = 1),
     best as (select word, n, count(*) as n_near, arg_min(near, (-near_n, near)) as form, max(near_n) as form_n from near group by all),
     forms as (select word, n_near, case when form_n >= 2 * n then form end as form, case when form_n >= 2 * n then form_n end as form_n from best),
     chain as (select word, word as root, 0 as step from v union all select c.word, f.form, step + 1 from chain c join forms f on f.word = c.root where f.form is not null),
     last as (select word, arg_max(root, step) as root from chain group by word)
select v.word, form, root, n, coalesce(n_near, 0) as n_near, form_n from v left join forms using (word) join last using (word)
"""
