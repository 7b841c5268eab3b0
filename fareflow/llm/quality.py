"""Quality rules as a bitmask ledger (operator 11).

Every rule is evaluated once for each document.  The *ledger* holds a document's
measurements and one number, ``failed``, with a bit for each rule it breaks.  It
is written down without the texts.  A *policy* is a version and a mask of the
rules that reject; applying one, or comparing many, only reads the ledger, and
what each rule is responsible for is worked out on the few distinct bitmasks.

Limits are ratios of whole numbers, so nothing is rounded.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import once
from .lines import BLANKS, split_lines

#: What a document is measured by, in the order of the ledger.
MEASURES = (
    "n_words",  # runs of characters other than ASCII white space
    "word_chars",  # code points in words
    "n_symbols",  # characters of SYMBOLS
    "n_lines",  # lines with a word
    "n_dup_lines",  # of these, equal to an earlier line
    "n_repeat_words",  # words in a window of three that stands twice in the text
    "n_letters",
    "n_capitals",
)
#: Columns that the ledger and the verdicts add.
ADDED = (*MEASURES, "failed", "kept")
#: Fixed value: characters that count as symbols, as a regular expression.
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """A document breaks the rule if ``broken``, SQL over the measures, is true."""

    name: str
    broken: str


#: A rule's bit is its place, so new rules are put at the end.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("word_length", "word_chars < 3 * n_words or word_chars > 10 * n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 4 * n_lines"),
    Rule("few_letters", "100 * n_letters < 60 * word_chars"),
    Rule("capitals", "2 * n_capitals > n_letters"),
)


def mask_of(names: list[str] | tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    """The bits of the named rules."""
    known = {r.name: 1 << i for i, r in enumerate(rules)}
    return sum(known[n] for n in set(names))


@dataclass(frozen=True)
class Policy:
    """A document is rejected if it breaks more than ``allowed`` of the rules in ``mask``."""

    version: str
    mask: int
    allowed: int = 0

    def rejects(self, failed: Column) -> Column:
        broken = failed.bitwiseAND(F.lit(self.mask).cast("long"))
        return broken != 0 if self.allowed == 0 else F.bit_count(broken) > self.allowed


#: Versions of the policy; a published one never changes.
BASE = Policy("base", mask_of(["few_words", "repeated_words"]))
FULL = Policy("full", mask_of([r.name for r in RULES]))


def _counts(text: Column, pattern: str) -> Column:
    """Characters that the class outside ``pattern`` leaves."""
    return F.char_length(F.regexp_replace(text, pattern, "")).cast("long")


def _repeats(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``words, n_words``) and ``places`` of the windows of three words that stand more than once.

    A window's hash and its place share one number, whose low ``bits`` hold the
    place; sorted, windows of one hash are neighbours.  Those that have such a
    neighbour are compared word by word.  Most texts have none, as the number of
    distinct hashes tells without a sort; their ``places`` are NULL.
    """
    hashes = "case when n_words >= 3 then transform(sequence(0, n_words - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2])) end"
    rows = once(rows, {"hashes": F.expr(hashes), "bits": F.expr("length(bin(n_words))")})
    packed = "sort_array(transform(hashes, (h, i) -> (h & shiftleft(-1L, bits)) | i))"
    rows = once(rows, {"packed": F.expr(f"case when size(array_distinct(hashes)) < n_words - 2 then {packed} end")})
    with_neighbour = "filter({0}, (x, k) -> (k > 0 and {1}[k - 1]{2} = x{2}) or (k < size({1}) - 1 and {1}[k + 1]{2} = x{2}))"
    same_hash = with_neighbour.format("packed", "packed", " >> bits")
    place = "cast(x & ~shiftleft(-1L, bits) as int)"
    window = "struct(concat_ws(' ', words[i], words[i + 1], words[i + 2]) as w, i as i)"
    rows = once(rows, {"windows": F.expr(f"sort_array(transform(transform({same_hash}, x -> {place}), i -> {window}))")})
    same_words = with_neighbour.format("windows", "windows", ".w")
    return once(rows, {"places": F.expr(f"transform({same_words}, x -> x.i)")})


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` and :data:`MEASURES`.

    A NULL text has no words; all its measures are 0.  Columns of the caller
    named like the added ones are replaced.
    """
    # The caller's columns are kept in one struct, so their names cannot clash with the helper columns.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    bare = F.btrim("text", F.lit(BLANKS))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[ \t\n\x0B\f\r]+"))
    lines = F.filter(split_lines(F.col("text")), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    rows = once(rows, {"words": words, "lines": lines})
    rows = once(
        rows,
        {
            "n_words": F.size("words"),
            "joined": F.array_join("words", ""),
            "n_lines": F.size("lines"),
            "n_distinct": F.size(F.array_distinct("lines")),
        },
    )
    rows = _repeats(rows.drop("lines", "text"))
    covered = "size(array_distinct(concat(places, transform(places, i -> i + 1), transform(places, i -> i + 2))))"
    made = {
        "n_words": F.col("n_words").cast("long"),
        "word_chars": F.char_length("joined").cast("long"),
        "n_symbols": _counts(F.col("joined"), SYMBOLS.replace("[", "[^") + "+"),
        "n_lines": F.col("n_lines").cast("long"),
        "n_dup_lines": (F.col("n_lines") - F.col("n_distinct")).cast("long"),
        "n_repeat_words": F.expr(f"case when places is null then 0L else cast({covered} as long) end"),
        "n_letters": _counts(F.col("joined"), r"\P{L}+"),
        "n_capitals": _counts(F.col("joined"), r"\P{Lu}+"),
    }
    rows = once(rows.select("row", "n_words", "joined", "n_lines", "n_distinct", "places"), made)
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ADDED], *MEASURES)


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns but the text), the measures, and ``failed``: bit i is set if rule i is broken.

    At most 63 rules.  One row for each row of ``docs``: rows that repeat an id
    are judged each by its own text, and an empty table gives none.  A measure
    that is 0 breaks only rules that say so.
    """
    if len(rules) > 63:
        raise ValueError("a ledger holds 63 rules")
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    measured = measure(docs, text_col)
    bits = [F.when(F.expr(r.broken), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, r in enumerate(rules)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.select(*[F.col(f"`{c}`") for c in keep if c not in ADDED], *MEASURES, failed.alias("failed"))


def apply(entries: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``kept``: false for documents that the policy rejects."""
    return entries.withColumn("kept", ~policy.rejects(F.col("failed")))


def ablations(entries: DataFrame, policies: list[Policy], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """What each rule does under each policy: ``version, rule, rejected, breaking, alone, kept_without``.

    ``rejected`` documents are rejected by the whole policy, ``breaking`` ones
    break the rule, ``alone`` break no other of the policy, and ``kept_without``
    would be kept if the rule were left out.  Documents are counted by their
    bitmask first, before the shuffle; each rule then only tests bits.
    """
    if not policies:
        raise ValueError("no policy to compare")
    masks = entries.groupBy("failed").agg(F.count(F.lit(1)).alias("_docs"))
    cases = [
        F.struct(F.lit(p.version).alias("version"), F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit"), F.lit(p.mask).cast("long").alias("mask"), F.lit(p.allowed).alias("allowed"))
        for p in policies
        for i, r in enumerate(rules)
        if p.mask >> i & 1
    ]
    rows = masks.select("failed", "_docs", F.inline(F.array(*cases)))
    broken = F.col("failed").bitwiseAND(F.col("mask"))
    left = broken.bitwiseAND(F.bitwise_not(F.col("bit")))
    rejected, spared = F.bit_count(broken) > F.col("allowed"), F.bit_count(left) <= F.col("allowed")
    count = lambda test: F.coalesce(F.sum(F.when(test, F.col("_docs"))), F.lit(0)).cast("long")
    return rows.groupBy("version", "rule").agg(
        count(rejected).alias("rejected"),
        count(F.col("failed").bitwiseAND(F.col("bit")) != 0).alias("breaking"),
        count(broken == F.col("bit")).alias("alone"),
        count(rejected & spared).alias("kept_without"),
    )


def broken_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """The names of the rules a ledger row breaks, from its bits."""
    names = [F.when(F.col("failed").bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.lit(r.name)) for i, r in enumerate(rules)]
    return F.array_compact(F.array(*names))
