"""Strict JSON objects and the recovery of an object from wrapped text.

A strict text is exactly one JSON object after trimming; repeated keys at any depth and
NaN/Infinity are refused. The JVM's ``try_parse_json`` decides the plain case. Text it does not
accept goes to a Python UDF for recovery and error text; every other row is null to that UDF.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaykit import fixed_values as fv
from assaykit.functions.stages import with_computed
from assaykit.functions.text import strip_field, strip_long, strip_text

_FOUND = T.StructType(
    [
        T.StructField("strict", T.BooleanType()),
        T.StructField("canonical", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
_FENCE = re.compile(r"```(?:json)?\s*(.*?)```", re.IGNORECASE | re.DOTALL)


def parse_object(text: Column) -> Column:
    """VARIANT of a strict JSON object, else null.

    ``try_parse_json`` ignores what follows the first value. The text is therefore put into an
    array with its own SHA-256 behind it, which no text can hold: only where one value reached the
    end of the text is the digest the second element.
    """
    body = strip_text(text)
    end = F.sha2(body, 256)
    return _decided(body, end, _in_array(body, end))


def _in_array(body: Column, end: Column) -> Column:
    return F.try_parse_json(F.concat(F.lit("["), body, F.lit(',"'), end, F.lit('"]')))


def _decided(body: Column, end: Column, in_array: Column) -> Column:
    alone = F.try_variant_get(in_array, "$[1]", "string") == end
    return F.when(
        F.startswith(body, F.lit("{")) & alone, F.try_variant_get(in_array, "$[0]", "variant")
    )


class _Refused(Exception):
    pass


def _no_repeated_key(pairs: list[tuple[str, object]]) -> dict[str, object]:
    members = dict(pairs)
    if len(members) < len(pairs):
        names = [name for name, _ in pairs]
        again = next(name for i, name in enumerate(names) if name in names[:i])
        raise _Refused(f"duplicate JSON object key: {again!r}")
    return members


def _no_constant(name: str) -> None:
    raise _Refused(f"non-finite JSON constant is not permitted: {name}")


def _objects_in(text: str, decoder: json.JSONDecoder):
    """Candidate values: the whole text, then whatever starts at each opening brace."""
    body = text.strip()
    try:
        yield True, decoder.decode(body)
    except (json.JSONDecodeError, RecursionError):
        pass
    brace = body.find("{")
    while brace >= 0:
        try:
            yield False, decoder.raw_decode(body, brace)[0]
        except (json.JSONDecodeError, RecursionError):
            pass
        brace = body.find("{", brace + 1)


def recover_object(text: str) -> tuple[bool, str | None, str | None]:
    """(strict, canonical JSON or None, error or None) of one text."""
    decoder = json.JSONDecoder(object_pairs_hook=_no_repeated_key, parse_constant=_no_constant)
    try:
        for number, part in enumerate([text, *_FENCE.findall(text)]):
            for whole, value in _objects_in(part, decoder):
                if isinstance(value, dict):
                    line = json.dumps(
                        value, ensure_ascii=False, sort_keys=True, separators=(",", ":")
                    )
                    return whole and number == 0, line, None
    except _Refused as refused:
        return False, None, str(refused)
    return False, None, None


@F.pandas_udf(_FOUND)
def _recover(texts: pd.Series) -> pd.DataFrame:
    found = [(None, None, None) if t is None else recover_object(t) for t in texts]
    return pd.DataFrame(found, columns=["strict", "canonical", "error"])


def with_object(df: DataFrame, text: str, prefix: str = "json") -> DataFrame:
    """Parse a text column once.

    Adds ``<prefix>_strict`` (boolean), ``<prefix>_object`` (VARIANT of the strict or recovered
    object) and ``<prefix>_error`` (refusal reason: repeated key or non-finite constant).
    """
    jvm, rest = f"__{prefix}_jvm", f"__{prefix}_rest"
    body, end, in_array = f"__{prefix}_body", f"__{prefix}_end", f"__{prefix}_array"
    found = F.col(f"__{prefix}_found")
    # each step is computed before the next reads it: one trim and one parse per text
    staged = with_computed(df, {body: strip_long(F.col(text), strip_text)})
    staged = with_computed(staged, {end: F.sha2(body, 256)})
    staged = with_computed(staged, {in_array: _in_array(F.col(body), F.col(end))})
    staged = with_computed(staged, {jvm: _decided(F.col(body), F.col(end), F.col(in_array))})
    return (
        staged.drop(body, end, in_array)
        .withColumn(rest, F.when(F.col(jvm).isNull(), F.col(text)))
        .withColumn(f"__{prefix}_found", _recover(F.col(rest)))
        .withColumn(f"{prefix}_strict", F.col(jvm).isNotNull() | F.coalesce(found["strict"], F.lit(False)))
        .withColumn(
            f"{prefix}_object", F.coalesce(F.col(jvm), F.try_parse_json(found["canonical"]))
        )
        .withColumn(f"{prefix}_error", found["error"])
        .drop(jvm, rest, f"__{prefix}_found")
    )


def members_of(value: Column) -> Column:
    """Top-level members of a VARIANT object by name. Compute it once and pass it on."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def string_member(members: Column, name: str) -> Column:
    """A member when it is a string, else null (numbers are not turned into text)."""
    member = members[name]
    return F.when(
        F.schema_of_variant(member) == "STRING", F.try_variant_get(member, "$", "string")
    )


def output_members(members: Column) -> Column:
    """The five output fields as nullable strings in one struct."""
    return F.struct(*[string_member(members, name).alias(name) for name in fv.OUTPUT_FIELDS])


def filled_fields(members: Column) -> Column:
    """How many of the five output fields are present, not null and not the empty string."""
    total = F.lit(0)
    for name in fv.OUTPUT_FIELDS:
        member = members[name]
        filled = (
            member.isNotNull()
            & (F.schema_of_variant(member) != "VOID")
            & ~F.coalesce(string_member(members, name) == "", F.lit(False))
        )
        total = total + filled.cast("int")
    return F.coalesce(total, F.lit(0))


def field_errors(output: Column, members: Column) -> Column:
    """Number of schema errors: failing fields plus unknown keys."""
    known = F.array(*[F.lit(name) for name in fv.OUTPUT_FIELDS])
    unknown = F.size(F.array_except(F.map_keys(members), known))
    return unknown + failing_fields(output)


def failing_fields(members: Column) -> Column:
    total = F.lit(0)
    for check in field_checks(members).values():
        total = total + (~check).cast("int")
    return total


def field_checks(members: Column) -> dict[str, Column]:
    """One Boolean per output field; a missing field fails."""
    low, high = fv.RESPONSE_LENGTH
    checks = {
        name: members[name].isin(*labels) for name, labels in fv.LABEL_DIMENSIONS.items()
    }
    checks["response"] = F.length(strip_field(members["response"])).between(low, high)
    checks["next_action"] = strip_field(members["next_action"]).rlike(fv.NEXT_ACTION)
    return {name: F.coalesce(check, F.lit(False)) for name, check in checks.items()}


def trimmed_output(members: Column) -> Column:
    """Output struct as stored after validation: free-text fields are trimmed."""
    return F.struct(
        members["category"].alias("category"),
        members["priority"].alias("priority"),
        members["sentiment"].alias("sentiment"),
        strip_field(members["response"]).alias("response"),
        strip_field(members["next_action"]).alias("next_action"),
    )


def chat_content(body: Column) -> Column:
    """Text of the first choice of a chat completion body, null if the body is not strict JSON."""
    parsed = parse_object(body)
    path = "$.choices[0].message.content"
    member = F.try_variant_get(parsed, path, "variant")
    return F.when(
        F.schema_of_variant(member) == "STRING", F.try_variant_get(parsed, path, "string")
    )


def chat_schema_valid(body: Column) -> Column:
    """The chat answer is one strict JSON object of the output schema."""
    members = members_of(parse_object(chat_content(body)))
    return F.coalesce(
        members.isNotNull() & (field_errors(output_members(members), members) == 0), F.lit(False)
    )


def model_claims(body: Column, model: Column, base_model: Column) -> Column:
    """Whether a model list names the model, and whether its parent is the base model."""
    records = F.from_json(
        F.to_json(F.try_variant_get(parse_object(body), "$.data", "variant")),
        "array<struct<id:string,parent:string>>",
    )
    first = F.get(F.filter(records, lambda record: record["id"] == model), F.lit(0))
    return F.struct(
        first.isNotNull().alias("listed"),
        F.coalesce(first["parent"] == base_model, F.lit(False)).alias("parent_matches"),
    )
