"""Text functions. Patterns are those of ``fixed_values``."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaykit import fixed_values as fv

# Characters whose NFKC form, case folding and word class the JVM expression below gets right:
# ASCII, the Latin-1 letters, and punctuation that normalises to non-word characters.
_PLAIN = (
    r"^[\x00-\x7F ¡§«°·»¿-ÿ"
    r"–—‘-„…]*$"
)
_NON_WORD_RUN = re.compile(r"\W+")


def strip_text(text: Column | str) -> Column:
    """Trim what Python's ``str.strip`` trims."""
    return F.btrim(F.col(text) if isinstance(text, str) else text, F.lit(fv.TRIMMED_FROM_TEXT))


def strip_field(text: Column | str) -> Column:
    """Trim Unicode white space only, as record fields are trimmed before their checks."""
    return F.btrim(F.col(text) if isinstance(text, str) else text, F.lit(fv.TRIMMED_FROM_FIELDS))


def strip_long(text: Column, strip: Callable[[Column], Column] = strip_field) -> Column:
    """``strip`` of a given column that may be long.

    Trimming reads the whole text; where its first and last byte are visible ASCII characters
    there is nothing to trim.
    """
    edges = [F.substring(text.cast("binary"), at, 1) for at in (1, -1)]
    first, last = (edge.between(F.lit(bytearray(b"!")), F.lit(bytearray(b"~"))) for edge in edges)
    return F.when(first & last, text).otherwise(strip(text))


@F.pandas_udf(T.StringType())
def _normalize_slow(texts: pd.Series) -> pd.Series:
    return texts.map(
        lambda text: text
        if text is None
        else _NON_WORD_RUN.sub(" ", unicodedata.normalize("NFKC", text).casefold()).strip()
    )


def with_normalized(df: DataFrame, text: Column, out: str = "normalized") -> DataFrame:
    """Add the text under NFKC, case folding and non-word runs collapsed to one space.

    Plain Latin text stays in the JVM. Only the rest is handed to Python: the UDF sees null
    for every other row.
    """
    raw, slow = f"__{out}_raw", f"__{out}_slow"
    lowered = F.replace(F.lower(F.col(raw)), F.lit("ß"), F.lit("ss"))
    in_jvm = F.trim(F.regexp_replace(lowered, rf"[^{fv.WORD}]+", " "))
    is_plain = (F.length(raw) == F.octet_length(raw)) | F.col(raw).rlike(_PLAIN)
    return (
        df.withColumn(raw, text)
        .withColumn(slow, F.when(~is_plain, F.col(raw)))
        .withColumn(
            out,
            F.when(F.col(slow).isNull(), in_jvm).otherwise(_normalize_slow(F.col(slow))),
        )
        .drop(raw, slow)
    )


def with_fingerprint(df: DataFrame, text: Column, out: str = "fingerprint") -> DataFrame:
    """Add the SHA-256 of the normalised text."""
    normalized = f"__{out}_text"
    return (
        with_normalized(df, text, normalized)
        .withColumn(out, F.sha2(F.col(normalized), 256))
        .drop(normalized)
    )


def matches_pii(text: Column, label: str) -> Column:
    """One PII pattern, tried only on text that has the characters every match needs."""
    found = text.rlike(fv.PII_PATTERNS[label])
    needed = {
        "email address": F.contains(text, F.lit("@")),
        "US social-security number": F.contains(text, F.lit("-")),
    }.get(label)
    return found if needed is None else needed & found


def _may_have_pii(text: Column) -> Column:
    return F.contains(text, F.lit("@")) | text.rlike(r"\p{Nd}")


def pii_hits(text: Column) -> Column:
    """Names of the PII patterns found, in pattern order."""
    hits = F.array_compact(
        F.array(*[F.when(matches_pii(text, label), F.lit(label)) for label in fv.PII_PATTERNS])
    )
    return F.when(_may_have_pii(text), hits).otherwise(F.array().cast("array<string>"))


def has_pii(text: Column) -> Column:
    found = F.lit(False)
    for label in fv.PII_PATTERNS:
        found = found | matches_pii(text, label)
    return _may_have_pii(text) & found


def safe_response(response: Column) -> Column:
    """Response text rule: length within bounds after trimming and no PII pattern; null is false."""
    trimmed = strip_text(response)
    low, high = fv.RESPONSE_LENGTH
    return F.coalesce(F.length(trimmed).between(low, high) & ~has_pii(trimmed), F.lit(False))


def placeholders(text: Column) -> Column:
    """All placeholder occurrences such as ``[ORDER_ID]``."""
    return F.regexp_extract_all(text, F.lit(f"({fv.PLACEHOLDER})"), 1)


def redact_secrets(text: Column) -> Column:
    """Mask credential assignments and hub tokens."""
    assigned = F.regexp_replace(text, fv.SECRET_ASSIGNMENT, "$1$2" + fv.REDACTED)
    return F.regexp_replace(assigned, fv.HUB_TOKEN, fv.REDACTED)


def sanitize_error(text: Column, limit: int = fv.ERROR_TEXT_LIMIT) -> Column:
    """Redacted error text, cut to the length an error field may have."""
    return F.substring(redact_secrets(text), 1, limit)


def fenced_blocks(text: Column) -> Column:
    """Bodies of fenced code blocks."""
    return F.regexp_extract_all(text, F.lit(fv.JSON_FENCE), 1)


def order_key(seed: int, scope: Column | str, record_id: Column) -> Column:
    """Seeded digest that orders records reproducibly; hex sorts like the digest bytes."""
    scope = F.lit(scope) if isinstance(scope, str) else scope
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), scope, record_id.cast("string")), 256)


def word_count(text: Column) -> Column:
    """Number of Unicode word runs."""
    return F.regexp_count(text, F.lit(rf"[{fv.WORD}]+"))


def contains_all(text: Column, needles: Sequence[str]) -> Column:
    return F.forall(F.array(*[F.lit(n) for n in needles]), lambda needle: F.contains(text, needle))


def contains_any(text: Column, needles: Sequence[str]) -> Column:
    return F.exists(F.array(*[F.lit(n) for n in needles]), lambda needle: F.contains(text, needle))


def only_cue(text: Column, cues: Sequence[str], expected: Column) -> Column:
    """True when the expected cue occurs and no other cue does."""
    array = F.array(*[F.lit(cue) for cue in cues])
    hits = F.filter(array, lambda cue: F.contains(text, cue))
    return (F.size(hits) == 1) & (F.get(hits, F.lit(0)) == expected)


# Identifiers that must not remain once placeholders are taken out.
EXTENDED_PII = {
    "ipv4 address": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9.])",
    "url": r"(?i)(?:https?://|www\.)\S+",
    "uuid": r"(?i)(?<![0-9a-f])[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}(?![0-9a-f])",
    "long number": r"(?<![0-9])[0-9]{9,}(?![0-9])",
    "credential value": r"(?i)(?:password|passcode|secret|token|api[_-]?key)\s*[:=]\s*[^\s,;]+",
}

# Wording that claims an action was completed or promises an outcome.
UNSAFE_CLAIMS = (
    r"(?i)\b(?:has|have) been (?:refunded|cancelled|canceled|deleted|unlocked|shipped|resolved)\b",
    r"(?i)\bi(?:'ve| have) (?:already )?(?:fixed|refunded|cancelled|reset|unlocked|resolved)\b",
    r"(?i)\bguarantee[ds]?\b",
    r"(?i)\bsend (?:me|us) your (?:password|card|code)\b",
)


def extended_pii_hits(text: Column) -> Column:
    """Names of all PII patterns found once placeholders are removed."""
    bare = F.regexp_replace(text, fv.PLACEHOLDER, " ")
    extra = F.array_compact(
        F.array(
            *[F.when(bare.rlike(pattern), F.lit(name)) for name, pattern in EXTENDED_PII.items()]
        )
    )
    return F.concat(pii_hits(bare), extra)


def unsafe_claim(text: Column) -> Column:
    found = F.lit(False)
    for pattern in UNSAFE_CLAIMS:
        found = found | text.rlike(pattern)
    return found


def same_number(left: Column, right: Column) -> Column:
    return F.abs(left - right) <= fv.NUMBER_TOLERANCE


def relative_path_ok(path: Column) -> Column:
    """Normalised relative path without traversal."""
    parts = F.split(path, "/")
    clean = F.forall(parts, lambda part: ~part.isin("", ".", ".."))
    return F.coalesce(F.length(path).between(1, 500) & clean, F.lit(False))


def real_digest(digest: Column) -> Column:
    """Well-formed SHA-256 that is not one repeated character."""
    return F.coalesce(
        digest.rlike(fv.SHA256_HEX) & ~digest.rlike(fv.REPEATED_CHARACTER), F.lit(False)
    )


def header_present(headers: Column, name: str) -> Column:
    """A header map holds the name in any case, with a value that is not blank."""
    return F.exists(
        F.map_entries(headers),
        lambda entry: (F.lower(entry["key"]) == name.lower())
        & (F.length(strip_text(entry["value"])) > 0),
    )


def local_user_path(text: Column, allowed: Sequence[str] = ()) -> Column:
    """Text mentions a path inside a user's home folder, other than the allowed ones."""
    unified = F.replace(text, F.lit("\\"), F.lit("/"))
    for path in allowed:
        unified = F.replace(unified, F.lit(path), F.lit(" "))
    return contains_any(unified, fv.LOCAL_USER_PATHS)
