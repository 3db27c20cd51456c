"""URL filter: longest matching rule, else naive Bayes over the words that host and path names are made of.

Names are the runs of letters of a host and of a path. The words of all pages' texts, with their counts, are a unigram model;
Viterbi splits each different name into the words of largest joint probability (an unknown run of k letters counts as
10 / (N * 10 ** k), N words in all). URLs that a rule decides are the training set of a multinomial naive Bayes over the words of
host and path, kept apart (add-one smoothing); it decides the URLs that no rule fits: `block` if that is likelier, else `allow`.

Nothing is held whole: a name asks a table of words for its own substrings, words ask a table of counts, URLs ask for
the scores of their names. Keys that hold more than one in HOT of the asking rows (HOT of them at most) are broadcast, so a common
host or word meets in no single task.

Defined results: a null URL, or one without `://`, has host and path '' and no rule; without a rule or a letter only the classes'
shares decide; without any URL that a rule decides, all others are allowed; a null or empty page adds no words; repeated rows count
again and null ids are kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchloom.llm.common import materialise, need, prepare, text_of

#: Fixed values: (host, path, verdict) of the rules.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters of a word at most: longer runs are never one word unless unknown. Keys that may be broadcast.
LONGEST, HOT = 24, 4096
LETTERS = "\\p{L}+"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path)."""
    host = F.translate(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def ruled(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule whose host is the host or above it and whose path begins the path; nulls without one."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def word_counts(texts: Column, rows: DataFrame) -> DataFrame:
    """word, n of the runs of letters in marked-up texts, tags left out, in lower case."""
    bare = F.lower(F.regexp_replace(F.coalesce(texts, F.lit("")), r"(?s)<[^>]*>", " "))
    return rows.select(F.explode(F.regexp_extract_all(bare, F.lit(LETTERS), F.lit(0))).alias("word")).where(F.length("word") <= LONGEST).groupBy("word").agg(F.count("*").alias("n"))


def asked(left: DataFrame, right: DataFrame, key: str, many: DataFrame) -> DataFrame:
    """left joined with right (one row a key) by key; many: key and how many rows of left have it, `rows`.

    Keys with over 1 / HOT of the rows are HOT at most and broadcast; the other rows are joined by a shuffle.
    """
    total = many.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    hot = materialise(many.where(F.col("rows") * HOT > total).select(key))
    if not hot.limit(1).count():
        return left.join(right, key)
    few = materialise(right.join(F.broadcast(hot), key, "left_semi"))
    rest = left.join(F.broadcast(hot), key, "left_anti").join(right.join(F.broadcast(hot), key, "left_anti"), key)
    return left.join(F.broadcast(few), key).select(*rest.columns).unionByName(rest)


def viterbi(name: str, known: list[tuple[int, int, int]], total: int) -> list[str]:
    """The words of largest joint probability that make up name; known: start, length, count of its substrings that are words.

    Of equal splits the one with the longer last word.
    """
    size = len(name)
    by_end: list[list[tuple[int, float]]] = [[] for _ in range(size + 1)]
    for start, length, n in known:
        by_end[start + length].append((start, math.log10(n / total)))
    best, back = [0.0] + [-math.inf] * size, [0] * (size + 1)
    # an unknown run costs 1 a letter and the same once: its best start is kept as it moves on
    open_score, open_start = -math.inf, 0
    base = 1 - math.log10(max(total, 1))
    for end in range(1, size + 1):
        if best[end - 1] + base > open_score:
            open_score, open_start = best[end - 1] + base, end - 1
        open_score -= 1
        best[end], back[end] = open_score, open_start
        for start, p in sorted(by_end[end]):
            if best[start] + p > best[end]:
                best[end], back[end] = best[start] + p, start
    out, end = [], size
    while end:
        out.append(name[back[end] : end])
        end = back[end]
    return out[::-1]


def segmented(names: DataFrame, words: DataFrame, total: int) -> DataFrame:
    """names (`name`, each once, and other columns) with `words`, the split of each name."""
    starts = F.sequence(F.lit(0), F.length("name") - 1)
    pieces = names.select("name", F.explode(starts).alias("start")).select("name", "start", F.explode(F.sequence(F.lit(1), F.least(F.length("name") - F.col("start"), F.lit(LONGEST)))).alias("length"))
    pieces = pieces.select("name", "start", "length", F.substring("name", F.col("start") + 1, F.col("length")).alias("word"))
    many = materialise(pieces.groupBy("word").agg(F.count("*").alias("rows")))
    hits = asked(pieces, words, "word", many).groupBy("name").agg(F.collect_list(F.struct("start", "length", "n")).alias("known"))  # LONGEST a letter of the name at most
    both = names.join(hits, "name", "left")
    fields = names.schema.fields
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known = [[(x["start"], x["length"], x["n"]) for x in k or []] for k in b.column("known").to_pylist()]
            split = [viterbi(name, k, total) for name, k in zip(b.column("name").to_pylist(), known, strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in fields), pa.array(split, pa.list_(pa.string()))], names=[*(f.name for f in fields), "words"])

    return both.select(*names.columns, "known").mapInArrow(run, f"{out}, words array<string>")


def names_of(host: Column, path: Column) -> Column:
    """Place and name of each run of letters: `host com`, `path en`."""
    runs = lambda c, place: F.transform(F.regexp_extract_all(F.lower(c), F.lit(LETTERS), F.lit(0)), lambda x: F.struct(F.lit(place).alias("place"), x.alias("name")))
    return F.concat(runs(host, "host"), runs(path, "path"))


def judged(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, url, html to page_id, host, path, rule, verdict, and the log10 odds of block for URLs that no rule fits (`score`)."""
    prepare(pages.sparkSession)
    host, path = split_url(pages["url"])
    rows = pages.select(pages["page_id"], host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = materialise(rows.withColumns({"rule": rule, "verdict": verdict, "_row": F.monotonically_increasing_id()}))
    shares = rows.agg(F.count_if(F.col("verdict") == "allow"), F.count_if(F.col("verdict") == "block"), F.count_if(F.col("verdict").isNull())).first()
    if not shares[2]:
        return rows.select("page_id", "host", "path", "rule", "verdict", F.lit(None).cast("double").alias("score"))
    words = materialise(word_counts(pages["html"], pages))
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    exploded = rows.select("_row", "verdict", F.explode(names_of(F.col("host"), F.col("path"))).alias("x")).select("_row", "verdict", "x.place", "x.name")
    count = lambda v: F.count_if(F.col("verdict") == v).alias(v)
    names = materialise(exploded.groupBy("place", "name").agg(count("allow"), count("block"), F.count_if(F.col("verdict").isNull()).alias("rows")))
    split = segmented(names.select("name").distinct(), words, total)
    parts = materialise(names.join(split, "name").select("place", "name", "allow", "block", "rows", F.explode("words").alias("word")))
    parts = parts.withColumn("token", F.concat_ws(" ", "place", "word"))
    counts = materialise(parts.groupBy("token").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"), F.count("*").alias("rows")))
    sums = counts.agg(F.coalesce(F.sum("allow"), F.lit(0)), F.coalesce(F.sum("block"), F.lit(0)), F.count("*")).first()
    odds = lambda n, all_: F.log10((n + 1) / F.lit(float(all_ + sums[2])))
    weights = counts.select("token", (odds(F.col("block"), sums[1]) - odds(F.col("allow"), sums[0])).alias("weight"))
    key = F.concat_ws(" ", "place", "name").alias("key")
    by_name = asked(parts.where("rows > 0").select(key, "token"), weights, "token", counts.select("token", "rows")).groupBy("key").agg(F.sum("weight").alias("weight"))
    by_name = materialise(by_name)
    asking = exploded.where("verdict is null").select("_row", key)
    scores = asked(asking, by_name, "key", names.where("rows > 0").select(key, "rows")).groupBy("_row").agg(F.sum("weight").alias("weight"))
    prior = math.log10((shares[1] + 1) / (shares[0] + 1)) if shares[0] + shares[1] else 0.0
    score = F.when(F.col("verdict").isNull(), F.coalesce("weight", F.lit(0.0)) + F.lit(prior))
    out = rows.join(scores, "_row", "left").withColumn("score", score)
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.when(F.round("score", 9) > 0, "block").otherwise("allow")).alias("verdict"), "score")


def op12_host_words(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    return judged(need(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id", "url", "html"))
