"""Corpus repair from the nested JSON of each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import lost, unmangled

# Columns of a repaired row and where their values are in the document. Kinds: s text, t time without
# fraction, b boolean, j verbatim JSON, J verbatim JSON and [] where it is missing; + for repaired text.
FIELDS: tuple[tuple[str, str, str], ...] = (
    ("id", "$.id", "s"), ("author_id", "$.author_id", "s"), ("created_at", "$.created_at", "t"), ("lang", "$.lang", "s"), ("text", "$.text", "s+"), ("text_completo", "$.text", "s+"),
    ("conversation_id", "$.conversation_id", "s"), ("in_reply_to_user_id", "$.in_reply_to_user_id", "s"), ("possibly_sensitive", "$.possibly_sensitive", "b"), ("reply_settings", "$.reply_settings", "s"),
    ("like_count", "$.public_metrics.like_count", "s"), ("retweet_count", "$.public_metrics.retweet_count", "s"), ("reply_count", "$.public_metrics.reply_count", "s"),
    ("quote_count", "$.public_metrics.quote_count", "s"), ("impression_count", "$.public_metrics.impression_count", "s"), ("bookmark_count", "$.public_metrics.bookmark_count", "s"),
    ("referenced_tweets", "$.referenced_tweets", "J+"), ("context_annotations", "$.context_annotations", "J+"), ("entities", "$.entities", "j+"), ("geo", "$.geo", "j+"),
    ("author_username", "$._author.username", "s+"), ("author_name", "$._author.name", "s+"), ("author_location", "$._author.location", "s+"), ("author_description", "$._author.description", "s+"),
    ("author_created_at", "$._author.created_at", "t"), ("author_verified", "$._author.verified", "b"), ("author_url", "$._author.url", "s"), ("author_profile_image_url", "$._author.profile_image_url", "s"),
    ("author_followers_count", "$._author.public_metrics.followers_count", "s"), ("author_following_count", "$._author.public_metrics.following_count", "s"),
    ("author_tweet_count", "$._author.public_metrics.tweet_count", "s"), ("author_listed_count", "$._author.public_metrics.listed_count", "s"),
    ("place_full_name", "$._place.full_name", "s+"), ("place_country", "$._place.country", "s+"), ("place_country_code", "$._place.country_code", "s"), ("place_type", "$._place.place_type", "s"),
    ("place_geo", "$._place.geo", "j"), ("place_contained_within", "$._place.contained_within", "j"),
)
REPORTED = ("text", "author_name", "author_location", "author_description")


def _schema(paths: list[list[str]]) -> T.StructType:
    """Strings at the ends of paths; a string of an object or list is its JSON."""
    heads = dict.fromkeys(p[0] for p in paths)
    rest = {h: [p[1:] for p in paths if p[0] == h and len(p) > 1] for h in heads}
    return T.StructType([T.StructField(h, _schema(rest[h]) if rest[h] else T.StringType()) for h in heads])


def parsed(doc: Column, columns: list[str]) -> Column:
    """The document as a struct with what the columns take from it; parsed once for all of them."""
    return F.from_json(doc, _schema([path[2:].split(".") for name, path, _ in FIELDS if name in columns] or [["id"]]))


def field(doc: str, path: str, kind: str) -> Column:
    """A value of the parsed document as the text that a repaired row holds."""
    got = F.coalesce(F.col(f"{doc}.{path[2:]}"), F.lit("[]" if kind[0] == "J" else ""))
    if kind[0] == "t":
        got = F.replace(got, F.lit(".000Z"), F.lit(""))
    elif kind[0] == "b":
        got = F.initcap(got)
    return unmangled(got) if kind.endswith("+") else got


def invalid_documents(src: DataFrame, raw_col: str = "raw_json") -> DataFrame:
    """Rows whose document cannot be parsed or declares no id."""
    ok = F.try_parse_json(F.col(raw_col)).isNotNull() & (F.coalesce(F.get_json_object(raw_col, "$.id"), F.lit("")) != "")
    return src.where(~F.coalesce(ok, F.lit(False)))


def repaired(src: DataFrame, raw_col: str = "raw_json") -> DataFrame:
    """src with every column that the document carries taken from it, text repaired both before and after parsing; other
    columns and the order of columns stay."""
    doc = unmangled(F.col(raw_col))
    wide = src.withColumn("__doc", doc).withColumn("__parsed", parsed(F.col("__doc"), src.columns))
    new = {name: field("__parsed", path, kind) for name, path, kind in FIELDS if name in src.columns}
    return wide.select(*[new[c].alias(c) if c in new else F.col("__doc").alias(c) if c == raw_col else F.coalesce(F.col(c), F.lit("")).alias(c) for c in src.columns])


def loss_share(df: DataFrame, text_col: str = "text") -> DataFrame:
    """rows, lossy rows and their share."""
    return df.agg(F.count("*").alias("rows"), F.count_if(lost(F.col(text_col))).alias("lossy")).withColumn("share", F.round(F.col("lossy") / F.greatest("rows", F.lit(1)), 6))


def repair(src: DataFrame, raw_col: str = "raw_json", text_col: str = "text", most_lossy: float = 0.2) -> DataFrame:
    """repaired(src), after the checks that stop a run before anything is written."""
    bad = invalid_documents(src, raw_col).limit(1).collect()
    if bad:
        raise ValueError(f"{raw_col} cannot be parsed or has no id: {str(bad[0][raw_col])[:120]!r}")
    share = loss_share(src, text_col).first()
    if share["share"] >= most_lossy:
        raise ValueError(f"{share['lossy']} of {share['rows']} rows have lost characters for good")
    return repaired(src, raw_col)


def report(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """What the repair changed, in one pass over the rows joined by key: ids, longer texts, line ends brought back, fields
    that changed, and fields that hold marks of loss."""
    changed = [c for c in ("id", "conversation_id", "author_id") if c in before.columns and c in after.columns]
    seen = [c for c in REPORTED if c in before.columns and c in after.columns]
    b = before.select(F.col(key).alias("__k"), *[F.col(c).alias(f"b_{c}") for c in {*changed, *seen, "text"}])
    a = after.select(F.col(key).alias("__k"), *[F.col(c).alias(f"a_{c}") for c in {*changed, *seen, "text"}])
    text_b, text_a = F.coalesce("b_text", F.lit("")), F.coalesce("a_text", F.lit(""))
    aggs = [F.count("*").alias("rows")]
    aggs += [F.count_if(F.coalesce(f"b_{c}", F.lit("")) != F.coalesce(f"a_{c}", F.lit(""))).alias(f"{c}_changed") for c in changed]
    aggs += [F.count_if(F.length(text_a) > F.length(text_b)).alias("untruncated"), F.count_if(text_a.contains("\n") & ~text_b.contains("\n")).alias("line_ends")]
    differs = [F.count_if(F.coalesce(f"b_{c}", F.lit("")) != F.coalesce(f"a_{c}", F.lit(""))) for c in seen]
    bad = [F.count_if(lost(F.col(f"a_{c}"))) for c in seen]
    aggs += [sum(differs[1:], differs[0]).alias("fields_repaired"), sum(bad[1:], bad[0]).alias("fields_lossy")]
    return b.join(a, "__k").agg(*aggs)


def mangled(x: Column) -> Column:
    """The damage that unmangled() takes back, for tests and fixtures."""
    from ..functions.text import CP1252

    return F.translate(F.decode(F.encode(x, "UTF-8"), "ISO-8859-1"), "".join(chr(b) for b in CP1252.values()), "".join(CP1252))
