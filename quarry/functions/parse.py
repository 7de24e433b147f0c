"""Model responses and judge texts to fields, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

#: The named parts of a response to each kind of prompt, in order (O-29 to O-32).
FIELDS = {
    "single": ("prompt", "result"),
    "hybrid": ("prompt", "result1", "result2"),
    "content_memory": ("premise", "round1", "result1", "round2", "result2"),
    "content_understand": ("round1", "round2", "result2", "round3", "result3"),
    "version_backtrack": ("round1", "round2", "result2", "round3", "result3"),
}
LINE_ENDS = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85  ]"


def pattern(kind: str) -> str:
    """name: text, with commas between the parts left out. (?d): only a newline ends a line."""
    names = FIELDS[kind]
    return "(?d)^" + r",?\s*".join(rf"{n}:\s*(.*?)" for n in names) + r"\s*$"


def response(text: Column, kind: str) -> Column:
    """Struct of the kind's fields, without blanks and a last full stop; null where the text has another form."""
    regex = pattern(kind)
    parts = [F.rtrim(strip(F.regexp_extract(text, regex, i + 1)), F.lit(".")).alias(n) for i, n in enumerate(FIELDS[kind])]
    return F.when(text.rlike(regex), F.struct(*parts))


def _listed(text: Column, key: str) -> tuple[Column, Column]:
    regex = rf"(?d)'{key}'\s*:\s*\[(.*?)\]"
    return text.rlike(regex), F.regexp_extract(text, regex, 1)


def recap(text: Column) -> Column:
    """O-28: struct(background, object, summary, ok) from JSON, or from anything that lists the three keys.

    ok tells whether all three were there. A summary given as a list counts by its first item.
    """
    json = F.try_parse_json(text)
    as_list = lambda key: F.try_variant_get(json, f"$.{key}", "array<string>")
    summary = F.coalesce(F.try_variant_get(json, "$.summary[0]", "string"), F.try_variant_get(json, "$.summary", "string"))
    single = F.replace(text, F.lit('"'), F.lit("'"))
    found = {k: _listed(single, k) for k in ("background", "object", "summary")}
    trimmed = lambda x: F.btrim(x, F.lit("' "))
    items = {k: F.transform(F.split(found[k][1], "', '"), trimmed) for k in ("background", "object")}
    none = F.array().cast("array<string>")

    def either(key: str, from_json: Column) -> Column:
        return F.when(json.isNotNull(), F.coalesce(from_json, none)).when(found[key][0], items[key]).otherwise(none).alias(key)

    has_json = as_list("background").isNotNull() & as_list("object").isNotNull() & summary.isNotNull()
    has_text = found["background"][0] & found["object"][0] & found["summary"][0]
    said = F.when(json.isNotNull(), F.coalesce(summary, F.lit(""))).otherwise(trimmed(found["summary"][1]))
    return F.struct(
        either("background", as_list("background")),
        either("object", as_list("object")),
        said.alias("summary"),
        F.coalesce(F.when(json.isNotNull(), has_json).otherwise(has_text), F.lit(False)).alias("ok"),
    )


def judge_values(text: Column) -> Column:
    """O-39: the numbers of lines of the form "name: digits"; any other line is passed over."""
    lines = F.transform(F.split(text, LINE_ENDS), strip)
    parts = F.transform(lines, lambda x: F.split(x, ": ", -1))
    kept = F.filter(parts, lambda p: (F.size(p) == 2) & F.get(p, 1).rlike("^[0-9]+$"))
    return F.transform(kept, lambda p: F.get(p, 1).try_cast("double"))


def judge_mean(text: Column) -> Column:
    """Mean of the judge's numbers to two decimals; null without any, or for a null text."""
    values = judge_values(text)
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return F.bround(F.try_divide(total, F.size(values)), 2)


def loose_judge_mean(text: Column) -> Column:
    """As judge_mean, but "name: 3 (Fair)" and several scores in one line count too."""
    values = F.transform(F.regexp_extract_all(text, F.lit(r":\s+([0-9]+)\b"), 1), lambda x: x.try_cast("double"))
    return F.bround(F.try_divide(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), F.size(values)), 2)


def pair_scores(text: Column) -> Column:
    """O-40: struct(score1, score2, objects_match) of a two-score judgement; a missing part is null."""
    number = lambda n: F.nullif(F.regexp_extract(text, rf"(?i)score\s*{n}\s*:\s*([0-9]+)", 1), F.lit("")).try_cast("int")
    match = F.nullif(F.lower(F.regexp_extract(text, r"(?i)objects match\s*:\s*(yes|no|true|false)", 1)), F.lit(""))
    return F.struct(number(1).alias("score1"), number(2).alias("score2"), match.isin("yes", "true").alias("objects_match"))


def accepted(scores: Column, least: int = 4) -> Column:
    """Our own filter on pair_scores: both scores reach least and the objects match."""
    return F.coalesce((scores["score1"] >= least) & (scores["score2"] >= least) & scores["objects_match"], F.lit(False))


def scores_consistent(values: Column) -> Column:
    """O-101: neither of the second and third score exceeds the first."""
    return (F.get(values, 1) <= F.get(values, 0)) & (F.get(values, 2) <= F.get(values, 0))


def scalar_score(text: Column) -> Column:
    """O-43: a number given as JSON, alone or as the first item of a list."""
    value = F.try_parse_json(text)
    return F.coalesce(F.try_variant_get(value, "$[0]", "double"), F.try_variant_get(value, "$", "double"))
