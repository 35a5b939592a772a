"""Classification rules, validity checks and retry decisions, as columns."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Message parts that decide an error's category, in this order.
ERROR_PATTERNS = {
    "transient": ("ConnectionError", "TimeoutError", "NetworkError", "TemporaryUnavailable", "ServiceUnavailable", "ConnectionRefusedError", "BrokenPipeError"),
    "resource": ("MemoryError", "OutOfMemory", "DiskSpace", "ResourceExhausted", "TooManyOpenFiles"),
    "configuration": ("InvalidCredentials", "MissingAPIKey", "ConfigurationError", "AuthenticationError", "PermissionDenied"),
    "data": ("CorruptFile", "InvalidFormat", "UnsupportedFormat", "DataError", "ValidationError", "PDFError"),
    "rate_limit": ("RateLimitExceeded", "TooManyRequests", "429", "ThrottlingException", "QuotaExceeded"),
}
#: Entity type synonyms.
ENTITY_TYPES = {
    "PERSON": ("PERSON", "PEOPLE", "NAME", "ATTORNEY", "JUDGE"),
    "ORG": ("ORG", "ORGANIZATION", "COMPANY", "CORPORATION", "COURT", "LAW_FIRM"),
    "LOCATION": ("LOCATION", "PLACE", "ADDRESS", "CITY", "STATE", "COUNTRY"),
    "DATE": ("DATE", "TIME", "DATETIME", "YEAR"),
}
#: Words in a file's name that tell its kind, the first that holds.
NAME_KINDS = {
    "tax": ("tax", "1040", "1065", "w2", "form", "schedule"),
    "certificate": ("death", "certificate", "birth", "marriage"),
    "email": ("email", "eml", "msg", "gmail", "yahoo"),
    "legal": ("affidavit", "complaint", "motion", "order", "judgment", "plea"),
    "financial": ("receipt", "payment", "invoice", "bill"),
    "property": ("deed", "title", "mortgage"),
}
#: Words in a path's first part that tell its category, the first that holds.
FOLDER_CATEGORIES = {
    "pleadings": ("plead",),
    "medical_records": ("medical", "health"),
    "discovery": ("discovery",),
    "correspondence": ("correspondence",),
    "exhibits": ("exhibit",),
    "depositions": ("depo",),
    "expert_reports": ("expert",),
    "financial_records": ("financial",),
}
#: Endings and types of audio and video files.
MEDIA_ENDINGS = (".m4a", ".mp3", ".wav", ".mov", ".mp4", ".avi", ".wmv")
MEDIA_TYPES = ("audio/", "video/", "application/octet-stream")
#: Characters of a page by kind of document, texts that say nothing, a marker that extraction may leave.
LEAST_CHARS = {"tax": 500, "legal": 300, "email": 200, "death": 800}
LEAST_CHARS_ELSE = 100
TRIVIAL = ("y", "EXHIBIT V", "")
ARTIFACT = "<|im_end|>"


def is_media(name: Column, mime: Column) -> Column:
    """Whether a file is audio or video, by its name's ending or its type."""
    by_name = [F.lower(name).endswith(e) for e in MEDIA_ENDINGS]
    by_type = [F.coalesce(F.lower(mime), F.lit("")).startswith(t) for t in MEDIA_TYPES]
    return reduce(or_, by_name + by_type)


def without_media(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """files(path, mime, size, cost_cents) without audio and video, and one row on
    what is left and what went: files, sizes, and costs in proportion to files."""
    marked = files.withColumn("_media", is_media(F.col("path"), F.col("mime")))
    kept, n = F.count_if(~F.col("_media")), F.count("*")
    size = lambda media: F.coalesce(F.sum(F.when(F.col("_media") == media, F.col("size"))), F.lit(0))
    cost = F.when(n > 0, F.sum("cost_cents") * kept / n).otherwise(0.0)
    report = marked.agg(kept.alias("files"), size(False).alias("size"), (n - kept).alias("excluded"), size(True).alias("excluded_size"), cost.alias("cost_cents"))
    return marked.where(~F.col("_media")).drop("_media"), report


def sufficient(text: Column, name: Column, pages: Column) -> Column:
    """Struct (sufficient, reason) of an extracted text: half of what its kind and
    pages lead to expect, nothing trivial, at most two artifacts a page."""
    clean = F.trim(F.replace(text, F.lit(ARTIFACT), F.lit("")))
    least = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in LEAST_CHARS.items() for x in pair]), first_match(name, NAME_KINDS, "default")), F.lit(LEAST_CHARS_ELSE))
    expected = least * pages
    artifacts = (F.length(text) - F.length(F.replace(text, F.lit(ARTIFACT), F.lit("")))) / len(ARTIFACT)
    told = lambda ok, *reason: F.struct(F.lit(ok).alias("sufficient"), F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in reason]).alias("reason"))
    return (
        F.when(text.isNull() | (text == ""), told(False, "No text extracted"))
        .when(F.length(clean) < expected * 0.5, told(False, "Extracted only ", F.length(clean).cast("string"), " chars, expected ~", expected.cast("string")))
        .when(clean.isin(*TRIVIAL), told(False, "Extraction appears incomplete"))
        .when(artifacts > pages * 2, told(False, "Too many OCR artifacts detected"))
        .otherwise(told(True, "Valid extraction"))
    )


def first_match(text: Column, patterns: dict[str, tuple[str, ...]], default: str) -> Column:
    """The first label, in order, any of whose words the text contains."""
    out = None
    for label, words in patterns.items():
        hit = F.lit(False)
        for word in words:
            hit = hit | F.lower(text).contains(word.lower())
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def error_category(message: Column) -> Column:
    return first_match(F.coalesce(message, F.lit("")), ERROR_PATTERNS, "permanent")


def retry_strategy(category: Column, tries: Column) -> Column:
    """Struct (strategy, delay in seconds) for a category and past retries."""
    made = lambda name, delay: F.struct(F.lit(name).alias("strategy"), delay.cast("long").alias("delay"))
    never = F.lit(0)
    transient = F.when(tries < 3, made("immediate", never)).when(tries < 6, made("exponential", F.pow(F.lit(2), tries - 2)))
    return (
        F.when(category == "transient", transient.otherwise(made("manual", never)))
        .when(category == "resource", made("linear", 60 * (tries + 1)))
        .when(category == "rate_limit", made("exponential", F.least(F.lit(3600), 60 * F.pow(F.lit(2), tries))))
        .otherwise(made("manual", never))
    )


def retry_backoff(tries: Column) -> Column:
    return F.least(F.lit(60), 5 * F.pow(F.lit(2), tries)).cast("long")


def entity_type_map(kind: Column) -> Column:
    """The canonical entity type of a synonym, null for any other."""
    out = None
    for name, words in ENTITY_TYPES.items():
        hit = F.upper(kind).isin(*words)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def status_fold(status: Column) -> Column:
    """Raw status text to failed, completed, pending or processing."""
    low = F.lower(F.coalesce(status, F.lit("")))
    return F.when(low.contains("fail") | low.contains("error"), "failed").when(
        low.contains("complet") | low.contains("success"), "completed").when(low.isin("", "pending", "started"), "pending").otherwise("processing")


def intake_priority(size_mb: Column) -> Column:
    return F.when(size_mb < 1, "high").when(size_mb < 20, "normal").otherwise("low")


def confidence_level(confidence: Column) -> Column:
    return F.when(confidence > 0.9, "high").when(confidence > 0.7, "medium").otherwise("low")


def sanitized(mentions: DataFrame) -> DataFrame:
    """Mentions with some text; confidence within 0 and 1; offsets that can't be
    right (before the text, or ending where they start) become the whole text's."""
    rows = mentions.where(F.length(F.trim("entity_text")) > 0)
    bad = (F.col("start") < 0) | (F.col("stop") <= F.col("start")) | F.col("start").isNull() | F.col("stop").isNull()
    return rows.withColumns({
        "confidence": F.least(F.lit(1.0), F.greatest(F.lit(0.0), "confidence")),
        "start": F.when(bad, 0).otherwise(F.col("start")), "stop": F.when(bad, F.length("entity_text")).otherwise(F.col("stop"))})


def violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, rule) for every rule that a row breaks; a rule that is null holds."""
    broken = F.array_compact(F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()]))
    return df.select(key, F.explode(broken).alias("rule"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that more than one row has."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of child without a parent; a null key has none."""
    return child.join(parent.select(key).distinct(), key, "left_anti")


def conformance(df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """Per declared column: whether it is there, nulls, and values that do not
    cast to the declared type.  One pass over the table."""
    cells = []
    for name, kind in declared.items():
        if name in df.columns:
            bad = F.count_if(F.col(name).isNotNull() & F.col(name).cast("string").try_cast(kind).isNull())
            cells.append(F.struct(F.lit(name).alias("name"), F.lit("present").alias("state"), F.count_if(F.col(name).isNull()).alias("nulls"), bad.alias("bad")))
        else:
            none = F.lit(0).cast("long")
            cells.append(F.struct(F.lit(name).alias("name"), F.lit("missing").alias("state"), none.alias("nulls"), none.alias("bad")))
    for name in df.columns:
        if name not in declared:
            none = F.lit(0).cast("long")
            cells.append(F.struct(F.lit(name).alias("name"), F.lit("extra").alias("state"), none.alias("nulls"), none.alias("bad")))
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
