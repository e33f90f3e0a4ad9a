"""Text cleaning and token expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Token patterns of the usual vectoriser defaults, spelt with Unicode classes.
WORDS_2PLUS = r"[\p{L}\p{N}_]{2,}"
WORDS_1PLUS = r"[\p{L}\p{N}_]+"

# Characters that end a token in the sequence dictionary.
SEQUENCE_BREAKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n"


def extract_digits(text: Column, as_number: bool = False) -> Column:
    """First run of digits, NULL where there is none; as a number it loses leading zeros."""
    digits = F.nullif(F.regexp_extract(text.cast("string"), r"(\d+)", 1), F.lit(""))
    return digits.cast("decimal(38,0)").cast("string") if as_number else digits


def strip_symbols(text: Column, keep_point: bool = True) -> Column:
    """Remove everything but word characters and blanks, accents kept.

    ``keep_point=False`` also removes the decimal point, so ``3.5`` becomes ``35``.
    """
    kept = r"[^\p{L}\p{N}_\s.]" if keep_point else r"[^\p{L}\p{N}_\s]"
    return F.regexp_replace(text, kept, "")


def normalise_text(text: Column, fixes: Mapping[str, str] | None = None, lower: bool = False) -> Column:
    """Separators to blanks, spelling fixes, then one pass of "two blanks to one"."""
    out = F.lower(text) if lower else text
    out = F.regexp_replace(out, r"[,\-.]", " ")
    for wrong, right in (fixes or {}).items():
        out = F.replace(out, F.lit(wrong), F.lit(right))
    return F.replace(out, F.lit("  "), F.lit(" "))


def token_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0)))


def tag(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def words(text: Column, pattern: str = WORDS_2PLUS) -> Column:
    """Lower-cased tokens in text order."""
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def ngrams(tokens: Column, sizes: Sequence[int]) -> Column:
    """All n-grams of the given sizes, joined by one blank. ``tokens`` should be a plain
    column: inside the loop over positions an expression would be evaluated again and again."""
    def of_size(n: int) -> Column:
        starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - (n - 1)))
        grams = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))
        return F.coalesce(grams, F.array().cast("array<string>"))

    return F.concat(*[tokens if n == 1 else of_size(n) for n in sizes])


def sequence_tokens(text: Column) -> Column:
    """Tokens of the sequence dictionary: lower case, split at any break character or blank."""
    spaced = F.translate(F.lower(text), SEQUENCE_BREAKS, " " * len(SEQUENCE_BREAKS))
    return F.filter(F.split(spaced, " "), lambda t: t != "")
