"""From file texts to accepted files: gates in a fixed order, secrets, two-level deduplication, outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Dedup, FileFilter, Quality, Security
from ..functions import credentials, pysource, records, text

#: How reasons begin that count as quality; all others count as cleaning.
QUALITY_REASONS = ("syntax_error", "tokenization_error", "generated_code", "high_line_repetition", "too_few_tokens")


def _first(*rules: tuple[Column, str]) -> Column:
    """The name of the first rule that holds; null if none does."""
    return F.coalesce(*(F.when(test, name) for test, name in rules), F.lit(None).cast("string"))


def clean_reason(raw: Column, code: Column, n_lines: Column, files: FileFilter, quality: Quality) -> Column:
    """Why a file's cleaned text (``code``) is refused before any question of quality."""
    n = F.length(code)
    return _first(
        (raw.isNull() | (raw == ""), "empty_file"),
        (text.is_binary(raw) & F.lit(quality.reject_binary), "binary_content"),
        (n < files.min_code_characters, "too_few_characters"),
        (n > files.max_code_characters, "too_many_characters"),
        (n_lines < files.min_code_lines, "too_few_code_lines"),
    )


def quality_reason(code: Column, stripped: Column, quality: Quality) -> Column:
    """The same for quality; stripped: the non-empty lines."""
    return _first(
        (text.has_marker(code, quality.generated_markers) & F.lit(quality.reject_generated_code), "generated_code"),
        (text.repeated_ratio(stripped) > quality.max_repeated_line_ratio, "high_line_repetition"),
    )


def process(files: DataFrame, file_filter: FileFilter, quality: Quality, column: str = "text", python: bool = True) -> DataFrame:
    """``files`` with code, characters, non_empty_lines, exact_hash, and reason (null: passed).

    With ``python``, also tokens and structural_hash from Python's parser, which sees only what passed all other gates.
    """
    raw = F.col(column)

    def of_lines(code: Column, stripped: Column) -> Column:
        n_lines = F.size(stripped).cast("long")
        reason = F.coalesce(clean_reason(raw, code, n_lines, file_filter, quality), quality_reason(code, stripped, quality))
        return F.struct(code.alias("code"), F.length(code).cast("long").alias("characters"), n_lines.alias("non_empty_lines"), reason.alias("reason"))

    def judged(code: Column) -> Column:
        return F.transform(F.array(text.code_lines(code)), lambda stripped: of_lines(code, stripped))[0]

    # all of it in one expression with the cleaned text bound once: as columns of their own, a filter on the reason would
    # be moved below them and carry a copy of the cleaning for each mention of the text
    out = files.withColumn("judged", F.transform(F.array(text.clean(raw)), judged)[0])
    out = out.withColumns({c: F.col("judged")[c] for c in ("code", "characters", "non_empty_lines", "reason")}).drop("judged")
    code = F.col("code")
    if python:
        # null instead of code: a condition around the call would not keep rejected files from the parser
        out = out.withColumn("parsed", pysource.analyze(F.when(F.col("reason").isNull(), code), quality.syntax_check))
        few = F.when(F.col("parsed.tokens") < file_filter.min_tokens, "too_few_tokens")
        out = out.withColumns({"reason": F.coalesce("reason", "parsed.error", few), "tokens": F.col("parsed.tokens"), "structural_hash": F.col("parsed.structural_hash")}).drop("parsed")
    return out.withColumn("exact_hash", F.when(F.col("reason").isNull(), records.exact_hash(code)))


def reason_class(reason: Column) -> Column:
    """"quality" or "cleaning"; null stays null."""
    return F.when(reason.rlike(f"^({'|'.join(QUALITY_REASONS)})"), "quality").when(reason.isNotNull(), "cleaning")


def first_eligible(files: DataFrame, most: int) -> DataFrame:
    """The first ``most`` files of each repository by ord; 0 means all."""
    if not most:
        return files
    rank = F.row_number().over(Window.partitionBy("repository").orderBy("ord"))
    return files.withColumn("nth", rank).filter(F.col("nth") <= most).drop("nth")


def scan_secrets(files: DataFrame, security: Security) -> DataFrame:
    """``files`` with findings and secret (whether they reject the file)."""
    none = F.expr("cast(array() as array<struct<type:string,line_number:bigint>>)")
    found = F.when(F.col("reason").isNull(), credentials.findings(F.col("code"))).otherwise(none) if security.enabled else none
    return files.withColumn("findings", found).withColumn("secret", (F.size("findings") > 0) & F.lit(security.reject_on_detection))


def dedup(files: DataFrame, registry: DataFrame | None, order: list[str], cfg: Dedup) -> DataFrame:
    """``files`` (exact_hash, structural_hash, all candidates for acceptance) with duplicate: null, "exact" or "structural".

    What the sequential rule does (take files in order, refuse one whose hash an accepted file or the registry has, the
    exact hash first) depends only on each class's first admissible file.  That is a grouped minimum, so a class of
    any size is combined before the shuffle, and the files are joined with their class's row.  ``files`` is read twice, so
    what is costly before it should be persisted or written.
    """
    if not (cfg.exact or cfg.structural):
        return files.withColumn("duplicate", F.lit(None).cast("string"))
    own = F.col("structural_hash") if cfg.structural else F.col("exact_hash")
    out = files.withColumn("class", own)
    for level, on in (("exact", cfg.exact), ("structural", cfg.structural)):
        known = F.lit(False)
        if registry is not None and on:
            seen = registry.filter(F.col("hash_type") == level).select(F.col("hash_value").alias(f"seen_{level}")).distinct()
            out = out.join(seen, F.col(f"{level}_hash") == F.col(f"seen_{level}"), "left")
            known = F.col(f"seen_{level}").isNotNull()
        out = out.withColumn(f"known_{level}", known)
    free = ~F.col("known_exact") & ~F.col("known_structural")
    at = F.struct(*order, "exact_hash")
    first = out.filter(free).groupBy(F.col("class").alias("of")).agg(F.min(at).alias("first"))
    out = out.join(first, F.col("class") == F.col("of"), "left")
    accepted = free & (F.struct(*(F.col(f"first.{c}") for c in order)) == F.struct(*order))
    same = F.lit(True) if not cfg.structural else (F.col("exact_hash") == F.col("first.exact_hash")) & F.lit(cfg.exact)
    named = F.when(F.col("known_exact"), "exact").when(F.col("known_structural"), "structural").when(accepted, F.lit(None)).when(same, "exact").otherwise("structural")
    return out.withColumn("duplicate", named).drop("class", "of", "first", "known_exact", "known_structural", "seen_exact", "seen_structural")


def outcome(size: Column | None, max_size: int, reason: Column, secret: Column, duplicate: Column, over_budget: Column) -> Column:
    """A file's one outcome, by the order of the gates."""
    large = F.coalesce(size > max_size, F.lit(False)) if size is not None else F.lit(False)
    return (
        F.when(large, "skipped_large_file")
        .when(reason.isNotNull(), "rejected_quality")
        .when(secret, "rejected_security")
        .when(duplicate == "exact", "rejected_exact_duplicate")
        .when(duplicate == "structural", "rejected_structural_duplicate")
        .when(over_budget, "storage_limit")
        .otherwise("accepted")
    )
