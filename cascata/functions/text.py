"""Text expressions: cleaning, canonical labels, tags, masks and salted hashes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cascata.schemas import ACCENTED, UNACCENTED

BLANKS = r"[\s\x1c-\x1f]"
STRIP_ENDS = rf"(?U)^{BLANKS}+|{BLANKS}+$"
# Texts that stand for a missing value.
NULL_TEXTS = ["nan", "None", "<NA>"]
NULL_TEXT_OR_ENDS = rf"(?U)^{BLANKS}*(?:{'|'.join(NULL_TEXTS)}){BLANKS}*$|^{BLANKS}+|{BLANKS}+$"


def strip(c: Column) -> Column:
    """Remove any white space at both ends."""
    return F.regexp_replace(c, STRIP_ENDS, "")


def clean_text(c: Column) -> Column:
    """Stripped text; blank text and the texts that mean nothing become null, in one pass."""
    return F.nullif(F.regexp_replace(c, NULL_TEXT_OR_ENDS, ""), F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def strip_accents(c: Column) -> Column:
    return F.translate(c, ACCENTED, UNACCENTED)


def canonical_label(c: Column, domain: list[str]) -> Column:
    """Official spelling of a label, ignoring case only; unknown labels stay as they are."""
    return _from_map(clean_text(c), {label.lower(): label for label in domain})


def official_label(c: Column, domain: list[str]) -> Column:
    """Official spelling ignoring case and accents, for text that carries all or none of them."""
    plain = str.maketrans(ACCENTED, UNACCENTED)
    spellings = {label.lower(): label for label in domain}
    spellings |= {label.lower().translate(plain): label for label in domain}
    return _from_map(c, spellings)


def _from_map(c: Column, spellings: dict[str, str]) -> Column:
    """Look a lower-cased text up in a constant map; text that is not there stays as it is."""
    table = F.create_map(*[F.lit(t) for pair in spellings.items() for t in pair])
    return F.coalesce(F.element_at(table, F.lower(c)), c)


def normalize_tags(tags_json: Column) -> Column:
    """Lower-case, trimmed, distinct, sorted tags of a JSON list; anything else gives []."""
    parsed = F.from_json(tags_json, "array<string>")
    lowered = F.transform(parsed, lambda t: F.lower(F.trim(t)))
    kept = F.filter(lowered, lambda t: t != "")
    return F.coalesce(F.array_sort(F.array_distinct(kept)), F.array().cast("array<string>"))


def match_text(c: Column) -> Column:
    """Form under which two spellings of one title or name are the same."""
    plain = F.lower(strip_accents(F.trim(c)))
    return F.nullif(F.regexp_replace(plain, r"\s+", " "), F.lit(""))


def salted_hash(c: Column, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(salt + "|"), c), 256)


def mask_name(c: Column) -> Column:
    words = F.split(F.trim(c), r"\s+")
    masked = F.array_join(F.transform(words, lambda w: F.concat(F.substring(w, 1, 1), F.lit("***"))), " ")
    return F.when(F.trim(c) != "", masked)


def mask_text(c: Column, visible: int = 20) -> Column:
    return F.when(F.length(c) <= visible, c).otherwise(
        F.concat(F.substring(c, 1, visible), F.lit("..."))
    )


def text_representation(title: Column, description: Column) -> Column:
    """Text that stands for a content: title, blank line, description; blanks skipped."""
    return F.concat_ws("\n\n", clean_text(title), clean_text(description))


def padded_master_id(content_id: Column) -> Column:
    """``CNT-00039``; ids longer than five digits are kept whole instead of being cut."""
    digits = content_id.cast("string")
    return F.concat(F.lit("CNT-"), F.when(F.length(digits) >= 5, digits).otherwise(F.lpad(digits, 5, "0")))
