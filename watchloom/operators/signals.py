"""Transcript signals: projection to the wire form, validation, flattening, comparison of two runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchloom import schemas
from watchloom.operators.tables import written

#: Largest log probability, tolerance of a comparison.
MOST_PLOG, TOLERANCE = 1e-4, 1e-6
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def raw_signals(language: Column, lang_probs: Column, segments: Column) -> Column:
    """The wire struct; tokens keep their identity and order."""
    return F.struct(F.lit(schemas.SIGNALS_VERSION).alias("schema_version"), language.alias("language"), lang_probs.alias("lang_probs"), segments.alias("segments"))


def ranked_languages(probs: Column) -> Column:
    """Named, finite probabilities in descending order, by code among equals."""
    ok = F.filter(probs, lambda x: x["code"].isNotNull() & (x["code"] != "") & x["p"].isNotNull() & ~F.isnan(x["p"]) & (F.abs(x["p"]) != float("inf")))
    return F.transform(F.array_sort(F.transform(ok, lambda x: F.struct((-x["p"]).alias("minus"), x["code"].alias("code"), x["p"].alias("p")))), lambda x: F.struct(x["code"].alias("code"), x["p"].alias("p")))


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def invalid_reason(segments: Column) -> Column:
    """no_speech_prob, p or plog, whichever is out of range first; null if all are in range."""
    unit = lambda x: finite(x) & x.between(0, 1)
    bad = lambda test: F.exists(segments, lambda s: F.exists(s["tokens"], test))
    return (
        F.when(F.exists(segments, lambda s: ~unit(s["no_speech_prob"])), "no_speech_prob")
        .when(bad(lambda t: ~unit(t["p"])), "p")
        .when(bad(lambda t: ~(finite(t["plog"]) & (t["plog"] <= MOST_PLOG))), "plog")
    )


def artifact_json(rows: DataFrame) -> Column:
    """Compact JSON; raw_signals is left out when null, lang_probs is written as null or as [code, p] pairs."""
    head = ["video_id", "source_url", "duration_s", "language_detected", "transcribed_at", "fetcher", "transcript_source", "model"]
    s, opts = F.col("raw_signals"), {"ignoreNullFields": "false"}
    value = lambda x: F.regexp_extract(F.to_json(F.array(x)), r"(?s)^\[(.*)\]\z", 1)  # noqa: E731 - a single JSON value
    listed = lambda xs: F.concat(F.lit("["), F.array_join(xs, ","), F.lit("]"))
    probs = listed(F.transform(s["lang_probs"], lambda x: listed(F.array(value(x["code"]), value(x["p"])))))
    signals = F.concat(F.lit('{"schema_version":'), value(s["schema_version"]), F.lit(',"language":'), value(s["language"]), F.lit(',"lang_probs":'), F.coalesce(probs, F.lit("null")), F.lit(',"segments":'), F.coalesce(F.to_json(s["segments"], opts), F.lit("null")), F.lit("}"))
    plain = F.to_json(F.struct(*head), opts)
    return F.when(s.isNull(), plain).otherwise(F.concat(F.regexp_replace(plain, r"\}\z", ',"raw_signals":'), signals, F.lit("}")))


def parsed_artifact(parsed: Column) -> Column:
    """The artifact of a line that from_json has read (see read_artifacts), lang_probs as structs again."""
    s = parsed["raw_signals"]
    probs = F.transform(s["lang_probs"], lambda x: F.struct(F.element_at(x, 1).alias("code"), F.element_at(x, 2).cast("float").alias("p")))
    whole = F.struct(s["schema_version"].alias("schema_version"), s["language"].alias("language"), probs.alias("lang_probs"), s["segments"].alias("segments"))
    names = [f.name for f in schemas.schema(schemas.ARTIFACT) if f.name != "raw_signals"]
    return F.struct(*[parsed[n].alias(n) for n in names], F.when(s.isNotNull(), whole).alias("raw_signals"))


def read_artifacts(lines: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Artifacts from their JSON, with the columns of `keep`; a line is parsed once.

    The parsed line is a column of its own: as the only element of an array it is exploded, so that it isn't put into each field that is
    read from it.
    """
    parsed = lines.select(*keep, F.explode(F.array(F.from_json(column, schemas.schema(schemas.ARTIFACT)))).alias("_a"))
    return parsed.select(*keep, parsed_artifact(F.col("_a")).alias("a")).select(*keep, "a.*")


def flat_tokens(segments: Column) -> Column:
    return F.flatten(segments["tokens"])


def transcript_text(segments: Column) -> Column:
    """The tokens' texts in order, without separator."""
    return F.concat_ws("", flat_tokens(segments)["text"])


def tokens(artifacts: DataFrame, key: str = "video_id") -> DataFrame:
    """One row a token: key, seg, tok, id, text, p, plog."""
    segs = artifacts.select(key, F.posexplode("segments").alias("seg", "s"))
    return segs.select(key, "seg", F.posexplode("s.tokens").alias("tok", "t")).select(key, "seg", "tok", "t.*")


def unsigned(x: Column, kind: T.DataType) -> Column:
    """x with zeros instead of minus zeros, at any depth."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(x == 0, F.lit(0).cast(kind)).otherwise(x)
    if isinstance(kind, T.ArrayType):
        return F.transform(x, lambda e: unsigned(e, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(x.isNotNull(), F.struct(*[unsigned(x[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    return x


def digest(d: DataFrame, names: list[str]) -> Column:
    """SHA-256 of the columns, which are equal if and only if these are: of their JSON with nulls, with plain zeros where it has minus zeros."""
    text = lambda cs: F.to_json(F.struct(*cs), {"ignoreNullFields": "false", "timestampFormat": MICROS + "XXX", "timestampNTZFormat": MICROS})
    plain, put = text([F.col(c) for c in names]), text([unsigned(F.col(c), d.schema[c].dataType).alias(c) for c in names])
    return F.sha2(F.when(F.regexp_like(plain, F.lit(r"-0\.0[,}\]]")), put).otherwise(plain).cast("binary"), 256)


def determinism(one: DataFrame, two: DataFrame, key: str = "video_id", ignore: tuple[str, ...] = ("transcribed_at",)) -> DataFrame:
    """key, verdict of two runs of one side: same, differs, missing; digests travel, not the artifacts."""
    names = [c for c in one.columns if c != key and c not in ignore]
    body = lambda d, n: d.select(key, digest(d, names).alias(n))
    both = body(one, "x").join(body(two, "y"), key, "full_outer")
    return both.select(key, F.when(F.col("x").isNull() | F.col("y").isNull(), "missing").when(F.col("x") == F.col("y"), "same").otherwise("differs").alias("verdict"))


def require_deterministic(verdicts: DataFrame) -> None:
    if n := verdicts.where("verdict <> 'same'").count():
        raise ValueError(f"{n} artifacts differ between two runs of the same side")


def sizes(segments: Column) -> Column:
    """The number of tokens of each segment."""
    return F.transform(segments["tokens"], lambda t: F.size(t))


def owners(n: Column) -> Column:
    """For each token, in order, the position of its segment; n: see sizes."""
    return F.flatten(F.transform(n, lambda k, i: F.array_repeat(i, k)))


def overlaps(pre: DataFrame, post: DataFrame, key: str = "video_id", tolerance: float = TOLERANCE) -> DataFrame:
    """Pairs of a post and a pre segment of the same key whose token ranges overlap, and whether no_speech_prob agrees.

    Segments that overlap share a token position, so the pairs of a document are read off its positions, without a join of segments;
    only sizes and no_speech_prob travel.
    """
    side = lambda d, n: d.select(key, sizes(F.col("segments")).alias(f"n{n}"), F.col("segments.no_speech_prob").alias(f"p{n}"))
    both = side(pre, "x").join(side(post, "y"), key)
    wide = 1 << 31
    met = F.zip_with(owners(F.col("nx")), owners(F.col("ny")), lambda i, j: j.cast("long") * wide + i)  # null where one side has no token
    each = both.select(key, "px", "py", F.explode(F.array_compact(F.array_distinct(met))).alias("_m"))
    i, j = (F.col("_m") % wide).cast("int"), F.floor(F.col("_m") / wide).cast("int")
    return each.select(key, j.alias("post_seg"), i.alias("pre_seg"), (F.abs(F.get("py", j) - F.get("px", i)) <= tolerance).alias("agrees"))


def spread_out(d: DataFrame, key: str) -> DataFrame:
    """key and the signals as an array a field: id, text, p, plog of the tokens, n (tokens) and silence of the segments; absent signals are empty ones."""
    s = d.select(key, F.coalesce(F.col("segments"), F.array().cast(d.schema["segments"].dataType)).alias("s"))
    t = flat_tokens(F.col("s"))
    return s.select(key, *[t[f].alias(f) for f in ("id", "text", "p", "plog")], sizes(F.col("s")).alias("n"), F.col("s.no_speech_prob").alias("silence"))


def fingerprints(d: DataFrame, key: str) -> DataFrame:
    """key, two hashes of the signals, whether a value is null or has no bound (hashes skip nulls), and whether a segment has no token."""
    probes = {"id": F.lit(-1), "text": F.lit("\0"), "n": F.lit(-1)} | {f: F.lit(float("nan")) for f in ("p", "plog", "silence")}
    whole = lambda f: F.coalesce(~F.array_contains(f, probes[f]), F.lit(False))  # noqa: E731 - null if an element is null
    bound = lambda f: F.coalesce(F.array_max(f) < float("inf"), F.lit(True)) & F.coalesce(F.array_min(f) > float("-inf"), F.lit(True))
    plain = F.lit(True)
    for f in probes:
        plain = plain & whole(f)
    for f in ("p", "plog", "silence"):
        plain = plain & bound(f)
    return spread_out(d, key).select(key, F.xxhash64(*probes).alias("one"), F.xxhash64(F.lit(1), *probes).alias("two"), plain.alias("plain"), F.exists("n", lambda k: k == 0).alias("bare"))


def compare(pre: DataFrame, post: DataFrame, key: str = "video_id", tolerance: float = TOLERANCE) -> DataFrame:
    """key, verdict, first_diff of two sides: the first check that fails, in the order missing, tokens, probabilities, coverage, windows.

    Hashes of 128 bits are joined first; only artifacts that differ in them (or have values that are null or without bound) are then
    joined whole and gone through, so what travels grows with the differences. An artifact without signals is one without segments;
    `missing` is one that a side doesn't have.
    """
    side = lambda d, n: fingerprints(d, key).select(key, F.struct("one", "two", "plain").alias(n), F.col("bare").alias(f"bare_{n}"))
    x, y = F.col("x"), F.col("y")
    settled = F.when(x.isNull() | y.isNull(), "missing").when((x == y) & x["plain"], F.when(F.col("bare_y"), "coverage").otherwise("pass"))
    met = written(side(pre, "x").join(side(post, "y"), key, "full_outer").select(key, settled.alias("verdict")))
    open_ = written(met.where("verdict is null").select(key).distinct())  # written, so that Spark knows how few they are
    done = met.where("verdict is not null").join(open_, key, "left_anti")
    return done.select(key, "verdict", F.lit(None).cast("int").alias("first_diff")).unionByName(gone_through(pre.join(open_, key, "left_semi"), post.join(open_, key, "left_semi"), key, tolerance))


def gone_through(pre: DataFrame, post: DataFrame, key: str, tolerance: float) -> DataFrame:
    """The comparison of whole signals.

    One join by key, of an array a field; overlapping segments share a token position, so no_speech_prob is compared position by
    position. Arrays that are equal as a whole aren't gone through.
    """

    def side(d: DataFrame, n: str) -> DataFrame:
        s = spread_out(d, key)
        return s.select(key, *[F.col(c).alias(f"{c}_{n}") for c in s.columns if c != key], F.lit(True).alias(f"has_{n}"))

    both = side(pre, "x").join(side(post, "y"), key, "full_outer")
    x, y = (lambda f: F.col(f"{f}_x")), (lambda f: F.col(f"{f}_y"))
    same = lambda f: x(f).eqNullSafe(y(f))
    # the difference of equal numbers is no number if they are none or have no bound
    near = lambda f: same(f) & F.coalesce(F.array_max(x(f)) < float("inf"), F.lit(True)) & F.coalesce(F.array_min(x(f)) > float("-inf"), F.lit(True))
    at = lambda equal, p, q, test: F.when(~equal, F.nullif(F.array_position(F.zip_with(p, q, test), F.lit(True)), F.lit(0)))
    other, apart = (lambda p, q: ~p.eqNullSafe(q)), (lambda p, q: F.abs(p - q) > tolerance)
    spread = lambda side: F.flatten(F.zip_with(side("silence"), side("n"), lambda p, k: F.array_repeat(p, k)))
    both = both.select(
        key, "has_x", "has_y", F.size("id_x").alias("long_x"), F.size("id_y").alias("long_y"),
        F.least(*[at(same(f), x(f), y(f), other) for f in ("id", "text")]).alias("token_at"), F.least(*[at(near(f), x(f), y(f), apart) for f in ("p", "plog")]).alias("far_at"),
        F.exists(y("n"), lambda k: k == 0).alias("bare"),  # covers no token of the other side
        at(same("n") & near("silence"), spread(x), spread(y), apart).alias("off_at"),
    )
    verdict = (
        F.when(F.col("has_x").isNull() | F.col("has_y").isNull(), "missing")
        .when((F.col("long_x") != F.col("long_y")) | (F.col("token_at") > 0), "tokens")
        .when(F.col("far_at") > 0, "probabilities")
        .when(F.col("bare"), "coverage")
        .when(F.col("off_at") > 0, "windows")
        .otherwise("pass")
    )
    out = both.withColumn("verdict", verdict)
    first = F.when((F.col("verdict") == "tokens") & (F.col("long_x") == F.col("long_y")), F.col("token_at") - 1).when(F.col("verdict") == "probabilities", F.col("far_at") - 1)
    return out.select(key, "verdict", first.alias("first_diff"))


def failed(verdicts: DataFrame) -> DataFrame:
    """The artifacts that don't pass, with the check that they fail."""
    return verdicts.where("verdict <> 'pass'")


def compare_summary(verdicts: DataFrame, key: str | None = None) -> DataFrame:
    """One row of totals; with the verdicts' key also a row for each artifact that fails, with the check that it fails.

    The list is rows, not one array, so that it isn't gathered in a task however long it is; the verdicts are worked out once.
    """
    verdicts = verdicts if key is None else written(verdicts)
    totals = verdicts.agg(F.count("*").alias("compared"), F.count_if(F.col("verdict") == "pass").alias("passed"), F.count_if(F.col("verdict") != "pass").alias("failed"))
    return totals if key is None else totals.unionByName(failed(verdicts).select(key, "verdict"), allowMissingColumns=True)
