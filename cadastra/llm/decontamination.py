"""Benchmark decontamination by template canonicalisation.

A word becomes a template token: A-Z lower-cased, ASCII punctuation dropped; then digits alone (or with st, nd, rd, th) become <num>,
a unit word <unit>, and a name <name>. Whether a capitalised word is a name can't be told from the word, so there are several templates
of a text, and each is compared with the same one of the other side:

within   names are capitalised words in the middle of a sentence
any      names are all capitalised words, whatever stands before them
cased    no word is a name, so neither capitals nor surroundings matter
exact    no placeholders at all; only for items and windows that the limits below drop from `cased`

Windows of `window` template tokens (the whole item, if it has fewer) of documents are hash-joined with those of benchmark
items. But for `exact`, windows need `least_plain` tokens that are no placeholders, and items `least` words. What `cased` or
`exact` holds of a copy doesn't depend on where it stands, so a copy of an item is found in any surroundings, however short
the item is.

Then slots are checked, so that a question with other numbers or names is caught, and a chance agreement of templates with
mixed-up values isn't. A window conflicts if, in itself, a name or unit of the item stands for two of the document or the
other way round (units in singular and plural are the same); numbers may become equal or different, but conflict where
a changed one becomes another number of the item that this alignment keeps. Windows that don't conflict count, if they
are at least half of those that a document shares with an item at one alignment; if not, those whose slots are equal word for
word still do.

Only the hashes of document windows meet the benchmark's; what matches, a small part, carries its slots. Windows are
hashed only where the hash of their first words is one of an item's window. A text is searched once for capitals, made plain
once and split once; all its templates come from these words.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bloom import as_literal, blocks_for, bloom, may_hold
from .common import table

#: Fixed values.
UNITS = (
    "mm", "cm", "m", "km", "inch", "inches", "ft", "feet", "mile", "miles", "mg", "g", "kg", "lb", "lbs", "ml", "l", "litre", "litres", "liter", "liters", "second", "seconds",
    "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "percent", "dollar", "dollars", "euro", "euros", "cent", "cents", "degrees",
)
_PLURALS = tuple(u for u in UNITS if u[-1] == "s" and u[:-1] in UNITS)
_PUNCTUATION = r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""
_NUMBER = "^[0-9]+(?:st|nd|rd|th)?$"
_CAPITAL = r"(?<![^ ])\p{Punct}*\p{Lu}\p{Ll}"
#: Private characters put before capitalised words; the second one before those in the middle of a sentence.
_MARK, _INNER = chr(0xE004), chr(0xE005)
_INSIDE = rf"(?<=[^.!?:;| ] ){_MARK}"
#: Private characters that stand for <num>, <unit> and <name> in templates.
_SLOTS = ""
#: Templates by number, and how many words decide whether a window is hashed.
WITHIN, ANY, CASED, EXACT = range(4)
FIRST = 3


def spaced(text: F.Column) -> F.Column:
    """The words of a text with one space between them. Null is the empty text."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "[ \\t-\\r]{2,}|[\\t-\\r]", " "))


def plain(text: F.Column) -> F.Column:
    """A-Z lower-cased, ASCII punctuation dropped."""
    return F.translate(text, string.ascii_uppercase + _PUNCTUATION, string.ascii_lowercase)


def marked_words(text: F.Column) -> F.Column:
    """The words of a spaced text, each plain, capitalised ones behind their mark."""
    return F.split(plain(F.regexp_replace(F.regexp_replace(text, _CAPITAL, _MARK + "$0"), _INSIDE, _INNER)), " ")


def _marked(t: F.Column) -> F.Column:
    return t.startswith(_MARK) | t.startswith(_INNER)


def _bare(t: F.Column) -> F.Column:
    return F.when(_marked(t), F.substring(t, 2, 1 << 30)).otherwise(t)


def cased(marked: F.Column, as_) -> F.Column:
    """The template `cased` of marked words. as_ gives what stands for a token: itself, or its hash."""
    number = lambda t: (t >= "0") & (t < ":") & t.rlike(_NUMBER)
    return F.transform(marked, lambda t: F.when(number(t), as_(F.lit(_SLOTS[0]))).when(_bare(t).isin(*UNITS), as_(F.lit(_SLOTS[1]))).otherwise(as_(_bare(t))))


def template(kind: int, marked: F.Column, cased_: F.Column, as_) -> F.Column:
    """The template of this kind of marked words, given cased() of them: as many tokens, each plain or its placeholder."""
    if kind == CASED:
        return cased_
    if kind == EXACT:
        return F.transform(marked, lambda t: as_(_bare(t)))
    named = _marked if kind == ANY else lambda t: t.startswith(_INNER)
    return F.zip_with(marked, cased_, lambda t, c: F.when(named(t) & (c != as_(F.lit(_SLOTS[1]))), as_(F.lit(_SLOTS[2]))).otherwise(c))


def slots(words_: F.Column, tokens: F.Column) -> F.Column:
    """For each word its placeholder and the value that it stands for, both empty for words that aren't placeholders."""
    slot = lambda w, t: F.struct(F.when(t.isin(*_SLOTS), t).otherwise("").alias("slot"), F.when(t.isin(*_SLOTS), plain(w)).otherwise("").alias("a"))
    return F.zip_with(words_, tokens, slot)


def first_words(h: F.Column, i: F.Column, lead: F.Column) -> F.Column:
    """One hash of the hashes of up to FIRST words from i on: of as many as `lead` says."""
    return F.xxhash64(*(F.when(lead > k, F.get(h, i + k)) for k in range(FIRST)))


def window_key(kind: F.Column, h: F.Column, i: F.Column, size: F.Column, window: int) -> F.Column:
    """One hash of the hashes of the `size` words from i on."""
    return F.xxhash64(kind, *(F.when(size > k, F.get(h, i + k)) for k in range(window)))


def item_windows(items: DataFrame, item: str, text: str, window: int, least: int, least_plain: int) -> DataFrame:
    """item_id, at, size, kind, first, key, slots of the windows of items; shorter items give one window, of all their words."""
    itself = lambda t: t
    one = items.select(F.col(item).alias("item_id"), spaced(F.col(text)).alias("text")).where("text != ''")
    split = one.select("item_id", F.split("text", " ").alias("w"), marked_words(F.col("text")).alias("m")).withColumn("c", cased(F.col("m"), itself))
    split = split.select("item_id", "w", F.array(*(template(k, F.col("m"), F.col("c"), itself) for k in (WITHIN, ANY, CASED, EXACT))).alias("t"))
    size = F.least(F.size("w"), F.lit(window))
    each = split.select("item_id", "w", "t", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("w") - size)).alias("at"))
    part = lambda c: F.slice(c, F.col("at") + 1, F.col("size"))
    each = each.select("item_id", "at", "size", part(F.col("w")).alias("w"), F.posexplode(F.transform("t", part)).alias("kind", "t"), part(F.col("t")[CASED]).alias("cased"))
    enough = lambda c: (F.col("size") >= least) & (F.size(F.filter(c, lambda t: (t != "") & ~t.isin(*_SLOTS))) >= least_plain)
    each = each.where(F.when(F.col("kind") == EXACT, ~enough("cased") & F.exists("t", lambda t: t != "")).otherwise(enough("t")))
    each = each.withColumn("h", F.transform("t", lambda t: F.xxhash64(t)))
    first = first_words(F.col("h"), F.lit(0), F.col("size"))
    key = window_key(F.col("kind"), F.col("h"), F.lit(0), F.col("size"), window)
    return each.select("item_id", "at", "size", "kind", first.alias("first"), key.alias("key"), slots(F.col("w"), F.col("t")).alias("slots"))


def contaminated(docs: DataFrame, items: DataFrame, id_: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = 10, least: int = 6, least_plain: int = 4) -> DataFrame:
    """(id, item_id, n_windows, n_slots) for each document and item that share consistent template windows.

    Rows of docs with equal ids count as one document. Null and empty texts, and items of punctuation only, match
    nothing. n_windows: different item windows found; n_slots: different slot values compared."""
    known = item_windows(items, item, item_text, window, least, least_plain)
    counted = known.groupBy("kind", "size").agg(F.count("*").alias("n")).collect()
    blocks = blocks_for(sum(r["n"] for r in counted))
    docs = docs.select(F.col(id_).alias("id"), spaced(F.col(text)).alias("text"))
    filter_, starts = (as_literal(bloom(known.select(F.col(c).alias("h")), blocks, bits)) for c, bits in (("key", 4), ("first", 1)))
    # Longer windows of a kind share the test of their first words; each shorter size has its own.
    searches = sorted({(r["kind"], min(r["size"], FIRST)) for r in counted}) or [(CASED, FIRST)]
    sizes = lambda k, lead: [r["size"] for r in counted if r["kind"] == k and min(r["size"], FIRST) == lead] or [window]
    of_kind = lambda k: template(k, F.col("marked"), F.col("cased"), F.xxhash64)
    tokens = docs.withColumn("marked", marked_words(F.col("text"))).withColumn("cased", cased(F.col("marked"), F.xxhash64))
    tokens = tokens.select("id", "text", *(of_kind(k).alias(f"h{k}") for k in sorted({k for k, _ in searches})))
    search = lambda k, lead: F.struct(F.lit(k).alias("kind"), F.lit(lead).alias("lead"), F.array(*map(F.lit, sorted(sizes(k, lead)))).alias("sizes"), F.col(f"h{k}").alias("h"))
    # Positions are rows only within a compiled stage: no copy of a text is made before a window passes both filters.
    kinds = tokens.select("id", "text", F.explode(F.array(*(search(k, lead) for k, lead in searches))).alias("s"))
    # What a filter tests is a row of its own as well, so that it is computed once.
    at = kinds.select("id", "text", "s", F.explode(F.sequence(F.lit(0), F.size("s.h") - 1)).alias("d_at"))
    at = at.select("id", "text", "s", "d_at", F.explode(F.array(first_words(F.col("s.h"), F.col("d_at"), F.col("s.lead")))).alias("start")).where(may_hold(starts, F.col("start"), blocks, 1))
    sized = at.select("id", "text", "s", "d_at", F.explode("s.sizes").alias("of")).where(F.col("d_at") + F.col("of") <= F.size("s.h"))
    key = window_key(F.col("s.kind"), F.col("s.h"), F.col("d_at"), F.col("of"), window)
    keyed = sized.select("id", "text", F.explode(F.array(F.struct(key.alias("key"), "d_at"))).alias("x"))
    found = keyed.where(may_hold(filter_, F.col("x.key"), blocks)).select("id", "text", "x.key", "x.d_at")
    hits = found.join(known, "key")
    values = F.transform(F.slice(F.split("text", " "), F.col("d_at") + 1, F.col("size")), plain)
    pairs = F.array_distinct(F.filter(F.zip_with("slots", values, lambda x, b: F.struct(x["slot"].alias("slot"), x["a"].alias("a"), b.alias("b"))), lambda x: x["slot"] != ""))
    # Texts that share an id are aligned each for itself.
    hits = hits.select("id", "item_id", "kind", F.xxhash64("text").alias("of"), "at", (F.col("d_at") - F.col("at")).alias("shift"), pairs.alias("pairs"))
    aligned = hits.groupBy("id", "of", "item_id", "kind", "shift").agg(F.collect_set(F.struct("at", "pairs")).alias("windows"))
    kept = F.filter(F.flatten("windows.pairs"), lambda x: (x["slot"] == _SLOTS[0]) & (x["a"] == x["b"]))
    aligned = aligned.select("id", "item_id", "windows", F.array_distinct(F.transform(kept, lambda x: x["a"])).alias("kept"))
    good = F.filter("windows", lambda w: ~_conflict(w["pairs"], F.col("kept")))
    same = F.filter("windows", lambda w: (F.size(w["pairs"]) > 0) & F.forall(w["pairs"], lambda x: x["a"] == x["b"]))
    counted = aligned.withColumn("good", good).withColumn("windows", F.when(2 * F.size("good") >= F.size("windows"), F.col("good")).otherwise(same)).where(F.size("windows") > 0)
    windows_found = F.size(F.array_distinct(F.flatten(F.collect_list("windows.at"))))
    return counted.groupBy("id", "item_id").agg(windows_found.cast("long").alias("n_windows"), F.max(F.size(F.array_distinct(F.flatten("windows.pairs")))).cast("long").alias("n_slots"))


def _one_to_one(pairs: F.Column, of=lambda x: x) -> F.Column:
    different = lambda f: F.size(F.array_distinct(F.transform(pairs, f)))
    both = different(lambda x: F.struct(of(x["a"]).alias("a"), of(x["b"]).alias("b")))
    return (different(lambda x: of(x["a"])) == both) & (different(lambda x: of(x["b"])) == both)


def _singular(unit: F.Column) -> F.Column:
    return F.when(unit == "feet", "ft").when(unit == "inches", "inch").when(unit.isin(*_PLURALS), F.regexp_replace(unit, "s$", "")).otherwise(unit)


def _conflict(pairs: F.Column, kept: F.Column) -> F.Column:
    """Whether a window's pairs of values contradict each other, or numbers that the alignment keeps."""
    number, unit, name = _SLOTS
    units, names = F.filter(pairs, lambda x: x["slot"] == unit), F.filter(pairs, lambda x: x["slot"] == name)
    mixed_up = F.exists(pairs, lambda x: (x["slot"] == number) & (x["a"] != x["b"]) & F.array_contains(kept, x["b"]))
    return mixed_up | ~_one_to_one(names) | ~(_one_to_one(units) | _one_to_one(units, _singular))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return contaminated(docs, items).withColumnRenamed("id", "doc_id")
