"""Quality rules, line first: judge every line, drop the lines that fail, then reject documents that lose too much.

All of it is built-in expressions; there is no shuffle, so a document's cost depends on nothing but its own text.

Results for special cases: a null or empty text has no words and fails the base rule; lines without a word are
neither counted nor dropped; rows are judged one by one, so repeated rows and null ids get their row each; a value equal
to a limit of the lines' symbols, marks or losses passes; texts of any length are read whole; an empty table gives an
empty result; other columns of the table pass through ``stage`` untouched, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, SPACE_CLASS, let, packed, unpacked, whole_text

SYMBOLS = "#*$%&|<>"
_WORD = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class Rules:
    """Limits of the line and document rules."""

    min_words: int = 50
    max_repeat_percent: int = 50
    #: A line fails at this many symbols for each hundred of its word characters.
    max_symbol_percent: int = 10
    #: A line is navigation from so many separators, if its words are at most this many for each separator.
    nav_separators: int = 3
    nav_words: int = 6
    #: A line is boilerplate if it has one of the phrases and at most this many words.
    boilerplate_words: int = 40
    boilerplate: tuple[str, ...] = (
        "accept cookies", "all rights reserved", "click here to", "cookie policy", "enable javascript", "lorem ipsum",
        "privacy policy", "sign up for our newsletter", "skip to content", "terms of use", "use of cookies",
        "alle rechte vorbehalten", "datenschutzerkl", "newsletter abonnieren", "nutzungsbedingungen", "zum inhalt springen",
        "aller au contenu", "conditions d'utilisation", "politique de confidentialit", "tous droits r", "utilisation de cookies",
        "condiciones de uso", "derechos reservados", "ir al contenido", "pol\u00edtica de privacidad", "uso de cookies",
    )
    #: A line fails for this many marks like "!!" or "??" for each hundred words.
    max_bang_percent: int = 20
    #: A document is rejected if more than this share of its word characters stood in failing lines.
    max_lost_percent: int = 50


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE_CLASS}+"), lambda w: w != "")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, SPACE, ""))


def symbol_count(text: Column, symbols: str = SYMBOLS) -> Column:
    """Counted only where there are any, as most texts have none."""
    return F.when(text.rlike(f"[{symbols}]"), F.length(text) - F.length(F.translate(text, symbols, ""))).otherwise(0)


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(_WORD))


def repeat_words(w: Column) -> Column:
    """How many words stand in 3-word windows that the text has twice or more.

    Equal windows become neighbours by sorting "w1 w2 w3 index"; words have no spaces, so windows are equal just
    when all before the last space is.  Most texts repeat no window and skip the sort: their windows' hashes all differ.
    """
    over = lambda f: F.transform(F.sequence(F.lit(0), F.size(w) - 3), f)
    hashes = over(lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))
    indexed = over(lambda i: F.concat_ws(" ", w[i], w[i + 1], w[i + 2], F.lpad(i.cast("string"), 9, "0")))

    def covered(s: Column) -> Column:
        keys = F.transform(s, lambda x: F.substring_index(x, " ", 3))
        index = lambda x: F.substring_index(x, " ", -1).cast("int")
        return let(
            keys,
            lambda k: F.size(
                F.array_distinct(
                    F.flatten(
                        F.transform(
                            F.filter(F.transform(s, lambda x, i: F.when(((i > 0) & (F.get(k, i - 1) == k[i])) | F.coalesce(F.get(k, i + 1) == k[i], F.lit(False)), index(x))), lambda x: x.isNotNull()),
                            lambda i: F.array(i, i + 1, i + 2),
                        )
                    )
                )
            ),
        )

    differ = let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
    return F.when(F.size(w) < 4, 0).when(differ, 0).otherwise(let(F.sort_array(indexed), covered))


def line_fails(line: Column, rules: Rules) -> Column:
    """Punctuation, navigation and boilerplate rules for one line that has a word; what is rare is asked first."""
    n = lambda: F.size(words(line))
    separators = F.length(line) - F.length(F.translate(line, "|»›•", ""))
    return (
        (line.rlike(f"[{SYMBOLS}]") & (symbol_count(line) * 100 > word_chars(line) * rules.max_symbol_percent))
        | (line.rlike("[|»›•]") & (separators >= rules.nav_separators) & (n() <= (separators + 1) * rules.nav_words))
        | (_marks(line) & (F.regexp_count(line, F.lit("[!?]{2}")) * 100 > n() * rules.max_bang_percent))
        | (_phrases(line, rules) & (n() <= rules.boilerplate_words))
    )


def _marks(text: Column) -> Column:
    return text.contains("!!") | text.contains("??") | text.contains("!?") | text.contains("?!")


def _phrases(text: Column, rules: Rules) -> Column:
    return let(F.lower(text), lambda low: reduce(or_, (low.contains(x) for x in rules.boilerplate), F.lit(False)))


def failing(text: Column, rules: Rules) -> Column:
    """The lines that fail; a text without anything that a rule looks for is not cut into lines."""
    suspect = text.rlike(f"[{SYMBOLS}»›•]") | _marks(text) | _phrases(text, rules)
    none = F.expr("cast(array() as array<string>)")
    return F.when(suspect, F.filter(F.split(text, "\n"), lambda x: x.rlike(_WORD) & line_fails(x, rules))).otherwise(none)


def clean_lines(docs: DataFrame, rules: Rules = Rules(), text: str = "text", prefix: str = "quality_") -> DataFrame:
    """``docs`` with ``<prefix>text`` (what stays), ``<prefix>lost_chars`` and ``<prefix>lines_failed``."""
    t = whole_text(text)
    lost = lambda x: F.struct(F.size(x).cast("long").alias("n"), F.aggregate(x, F.lit(0).cast("long"), lambda a, y: a + word_chars(y)).alias("chars"))
    out = docs.withColumn(f"{prefix}failed", let(failing(t, rules), lost))
    kept = F.array_join(F.filter(F.split(t, "\n"), lambda x: ~(x.rlike(_WORD) & line_fails(x, rules))), "\n")
    failed = F.col(f"{prefix}failed")
    return out.withColumns({f"{prefix}text": F.when(failed["n"] == 0, t).otherwise(kept), f"{prefix}lost_chars": failed["chars"], f"{prefix}lines_failed": failed["n"]}).drop(f"{prefix}failed")


def judge(docs: DataFrame, rules: Rules = Rules(), text: str = "text", prefix: str = "quality_") -> DataFrame:
    """``clean_lines`` with the counts, ``<prefix>base_failed`` and ``<prefix>kept`` of every document."""
    t = whole_text(text)
    col = lambda x: F.col(prefix + x)
    counts = let(
        words(t),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
            repeat_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    out = clean_lines(docs, rules, text, prefix).withColumns(
        {
            f"{prefix}counts": counts,
            f"{prefix}n_symbols": symbol_count(t).cast("long"),
            f"{prefix}n_dup_lines": let(lines_with_words(t), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        }
    )
    out = out.withColumns({f"{prefix}{x}": col("counts")[x] for x in ("n_words", "word_chars", "n_repeat_words")}).drop(f"{prefix}counts")
    out = out.withColumn(f"{prefix}base_failed", (col("n_words") < rules.min_words) | (100 * col("n_repeat_words") > rules.max_repeat_percent * col("n_words")))
    return out.withColumn(f"{prefix}kept", ~col("base_failed") & (100 * col("lost_chars") <= rules.max_lost_percent * col("word_chars")))


def stage(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that are kept, with their failing lines gone; same columns."""
    found = judge(packed(docs), rules, "row_.text").filter("quality_kept")
    return unpacked(found, docs.columns, F.col("quality_lines_failed") > 0, F.col("quality_text"))


def query(docs: DataFrame) -> DataFrame:
    """The rows of ``op7_quality_rules``."""
    return judge(docs.select("doc_id", "text")).select(
        "doc_id", *(F.col(f"quality_{x}").alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars", "lines_failed"))
    )
