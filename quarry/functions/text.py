"""Keys, templates and clean-up of texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prompts that the edit drivers always send (single add and remove; turns that add or remove; style),
#: and what the reference-extraction driver appends.
SINGLE_EMPTY_PROMPT = "empty, emptiness, blank, vacent"
TURN_EMPTY_PROMPT = "empty, emptiness, blank"
STYLE_PROMPT = "Studio Ghibli, hand-drawn animation style, masterpiece, high score."
EXTRACT_SUFFIX = ". pure background. high quality, very detailed. 8k."
PLACEHOLDER = "{{{}}}"


def strip(text: Column) -> Column:
    """Without white space at both ends, Unicode included."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def record_key(path: Column, suffix: str = ".jpg") -> Column:
    """O-23: slashes and every suffix dropped. Two paths can share a key, so keep the path as well."""
    return F.replace(F.replace(path, F.lit("/"), F.lit("")), F.lit(suffix), F.lit(""))


def task_id(path: Column, base: str | None = None) -> Column:
    """O-24, O-25: up to the first dot, with slashes as underscores; base/ is dropped first."""
    if base:
        path = F.replace(path, F.lit(base + "/"), F.lit(""))
    return F.replace(F.split_part(path, F.lit("."), F.lit(1)), F.lit("/"), F.lit("_"))


def fill(template: str, value: Column, placeholder: str = PLACEHOLDER, drop: str = "\n\t") -> Column:
    """O-26: the template with value in place of the placeholder, without the characters of drop."""
    text = F.replace(F.lit(template), F.lit(placeholder), value)
    return strip(F.translate(text, drop, ""))


def clean_response(text: Column) -> Column:
    """O-27: one line, without backticks and blanks at its ends."""
    return F.btrim(F.replace(text, F.lit("\n"), F.lit("")), F.lit("` "))


def without_apostrophes(text: Column) -> Column:
    """O-35."""
    return F.replace(text, F.lit("'"), F.lit(""))


def extraction_prompt(result: Column) -> Column:
    """O-37."""
    return F.concat(result, F.lit(EXTRACT_SUFFIX))


def drop_keywords(items: Column, keywords: list[str]) -> Column:
    """O-10: items whose lower case is not among the keywords."""
    unwanted = F.array(*[F.lit(k.lower()) for k in keywords]).cast("array<string>")
    return F.filter(items, lambda x: ~F.array_contains(unwanted, F.lower(x)))


def label_list(objects: Column, backgrounds: Column) -> Column:
    """O-73: objects, then backgrounds, repeats kept; a null list is an empty one."""
    none = F.array().cast("array<string>")
    return F.concat(F.coalesce(objects, none), F.coalesce(backgrounds, none))


def at_most_words(text: Column, most: int) -> Column:
    """O-96, O-97, O-100."""
    return F.size(F.split(strip(text), r"(?U)\s+")) <= most


def all_in_caption(items: Column, caption: Column) -> Column:
    """O-95: every item is a substring of the caption."""
    return F.forall(items, lambda x: F.contains(caption, x))


def noun_or_none(op: Column, result: Column) -> Column:
    """O-98: "None" just for operations that leave no object to name."""
    return F.when(op.isin("add", "remove"), F.lower(result) == "none").otherwise(F.lower(result) != "none")


def premise_not_repeated(premise: Column, rounds: list[Column]) -> Column:
    """O-99."""
    out = F.lit(True)
    for r in rounds:
        out = out & ~F.contains(r, premise)
    return out


#: Words that give an order, words of a sentence, and words that tell nothing of an object.
ORDERS = ("add", "adjust", "change", "delete", "insert", "make", "place", "put", "remove", "replace", "swap", "turn")
SENTENCE = ("are", "be", "has", "have", "is", "should", "was", "were", "will")
PLAIN = ("a", "all", "an", "and", "any", "are", "as", "at", "be", "by", "every", "for", "from", "in", "is", "it", "its", "must", "of", "on", "or", "should", "the", "their", "to", "with")


def words(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def noun_phrase(text: Column, most: int = 8) -> Column:
    """Whether a text can name an object: one to most words, none a word of a sentence, the first none of the orders, and no mark
    that ends or divides sentences. "None" names nothing. A rule of form: it knows no grammar."""
    own = words(text)
    sentence, orders, none = (F.array(*map(F.lit, x)) for x in (SENTENCE, ORDERS, ("none",)))
    plain = ~text.rlike(r"[.;:!?\n]\s*\S") & ~F.arrays_overlap(own, sentence) & ~F.array_contains(orders, F.get(own, 0)) & (own != none)
    return F.size(own).between(1, most) & F.coalesce(plain, F.lit(False))


def result_named(op: Column, result: Column) -> Column:
    """O-98: "None" for operations that leave no object to name, else a noun with or without adjectives; null is neither."""
    none = F.lower(F.rtrim(strip(result), F.lit("."))) == "none"
    return F.coalesce(F.when(op.isin("add", "remove"), none).otherwise(noun_phrase(result)), F.lit(False))


def shares_run(premise: Column, text: Column, run: int = 3) -> Column:
    """Whether run words of the premise, all of a shorter one, stand side by side in the text. Null shares nothing."""
    own = words(premise)
    k = F.least(F.lit(run), F.size(own))
    bordered = lambda ws: F.concat(F.lit(" "), F.array_join(ws, " "), F.lit(" "))
    runs = F.transform(F.sequence(F.lit(1), F.size(own) - k + 1), lambda i: bordered(F.slice(own, i, k)))
    return F.coalesce(F.when(k > 0, F.exists(runs, lambda r: F.contains(bordered(words(text)), r))), F.lit(False))


def reflects(premise: Column, result: Column, least: float = 0.5) -> Column:
    """Whether at least this share of the premise's telling words is in the result; a premise without any is always reflected."""
    telling = F.array_distinct(F.filter(words(premise), lambda w: ~w.isin(*PLAIN)))
    met = F.size(F.array_intersect(telling, words(result)))
    return F.coalesce(F.when(F.size(telling) == 0, True).otherwise(met >= least * F.size(telling)), F.lit(False))


def premise_kept(premise: Column, rounds: list[Column], results: list[Column]) -> Column:
    """O-99: struct(fresh, reflected): no round repeats the premise in its own words, and every result shows it."""
    fresh, shown = F.lit(True), F.lit(True)
    for r in rounds:
        fresh = fresh & ~shares_run(premise, r)
    for r in results:
        shown = shown & reflects(premise, r)
    return F.struct(fresh.alias("fresh"), shown.alias("reflected"))
