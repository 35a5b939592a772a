"""Text functions: columns in, columns out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(text: Column) -> Column:
    """Without white space at the ends (all of it, not just spaces)."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def clean_text(text: Column) -> Column:
    """Without end markers and control characters; long gaps become a blank line."""
    text = F.regexp_replace(text, r"<\|im_end\|>", "")
    text = F.regexp_replace(text, r"\s{3,}", "\n\n")
    return strip(F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", ""))


#: Markdown rewrites, in this order.
MARKDOWN = (
    (r"!\[[^\]]*\]\([^)]*\)", ""),
    (r"(?m)^#{1,6}\s+", ""),
    (r"\[([^\]]+)\]\([^)]*\)", "$1"),
    (r"(\*\*\*|\*\*|\*|___|__|_)(?=\S)(.+?)(?<=\S)\1", "$2"),
    (r"(?m)^\s*([-*_]\s*){3,}$", ""),
    (r"(?s)```[^\n]*\n(.*?)```", "$1"),
    (r"`([^`]+)`", "$1"),
    (r"(?m)^\|?[\s:|-]+\|[\s:|-]*$", ""),
    (r"\$\$?([^$]+)\$\$?", "$1"),
    (r"[ \t]+", " "),
)


def strip_markdown(text: Column) -> Column:
    """Plain text of markdown; blank lines are dropped, lines trimmed."""
    for pattern, to in MARKDOWN:
        text = F.regexp_replace(text, pattern, to)
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: F.length(x) > 0)
    return F.array_join(lines, "\n")


def simple_markdown(text: Column) -> Column:
    """Paragraphs with short ALL-CAPS ones as ##, short numbered ones as ###."""
    def mark(p: Column) -> Column:
        short = F.length(p) < 80
        return F.when(short & p.rlike("[A-Z]") & (F.upper(p) == p), F.concat(F.lit("## "), p)).when(
            short & p.rlike(r"^\d+\."), F.concat(F.lit("### "), p)).otherwise(p)

    return F.array_join(F.transform(F.split(text, r"\n\s*\n"), mark), "\n\n")


def find_all(text: Column, pattern: str | Column) -> Column:
    """Array of (match, start, end) from left to right, starts from 0."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    begin = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<match:string,start:int,stop:int>>").alias("found"))

    def step(state: Column, match: Column) -> Column:
        place = F.call_function("locate", match, text, state["at"])
        one = F.struct(match.alias("match"), (place - 1).alias("start"), (place - 1 + F.length(match)).alias("stop"))
        return F.struct((place + F.length(match)).alias("at"), F.concat(state["found"], F.array(one)).alias("found"))

    return F.aggregate(matches, begin, step, lambda s: s["found"])


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\s]+"))


def sanitize_filename(name: Column) -> Column:
    name = F.regexp_replace(name, r"[^A-Za-z0-9._-]", "_")
    name = F.regexp_replace(F.regexp_replace(name, "_+", "_"), "^_+|_+$", "")
    return F.substring(name, 1, 200)


def clean_component(part: Column) -> Column:
    return F.substring(F.regexp_replace(F.lower(F.trim(part)), r"\s+", "_"), 1, 50)


#: Date formats tried in this order.
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "M/d/yyyy", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "yyyyMMdd")


def parse_date(text: Column) -> Column:
    """The date a text states in one of the known formats, else null."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS]).cast("date")


def parse_money(text: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(text, r"[0-9][0-9,]*(\.[0-9]+)?", 0), ",", "").try_cast("double")


def json_response(text: Column, schema: str) -> Column:
    """Parse a response as JSON; failing that, the first {...} in it."""
    inner = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    whole = F.ltrim(text).startswith("{") | F.ltrim(text).startswith("[")
    return F.from_json(F.when(whole, text).when(inner != "", inner), schema)


def labelled_field(text: Column, label: str) -> Column:
    value = F.trim(F.regexp_extract(text, rf"(?im)^\s*{label}\s*:\s*(.*)$", 1))
    return F.when(value != "", value)
