"""From message envelopes to typed events, and the log of what was rejected."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickweir.functions.coerce import coerce
from clickweir.functions.document import is_document, reject_reason, spelled_key
from clickweir.functions.text import null_text

MATCH_RULES = ("exact", "sql")


def extract_fields(
    messages: DataFrame,
    fields: Sequence[str] | Mapping[str, str],
    keep: Sequence[str] = (),
    value: str = "value",
) -> DataFrame:
    """Top-level fields of a JSON text column, as text.

    ``fields`` names the wanted keys, or maps output names to keys. The text is
    tokenised once for all of them, other keys are skipped, the last non-null
    occurrence of a repeated key wins, and a malformed document gives a row of
    NULLs. Nothing is typed here and no null rule is applied.
    """
    wanted = dict(fields) if isinstance(fields, Mapping) else {f: f for f in fields}
    clash = sorted(set(wanted) & set(keep))
    if clash:
        raise ValueError(f"output names used twice: {clash}; map them to other names")
    if not wanted:
        return messages.select(*keep)
    return messages.select(
        *keep, F.json_tuple(value, *wanted.values()).alias(*wanted)
    )


def parse_events(
    messages: DataFrame,
    columns: str | StructType,
    mode: str = "number",
    match: str = "exact",
    keep: Sequence[str] = ("partition", "offset", "timestamp"),
    rowkey: str | None = "rowkey",
    document: str | None = None,
    types: Mapping[str, str] | None = None,
    skip_rejects: bool = False,
) -> DataFrame:
    """Typed events, one row per message.

    ``columns`` is a DDL string or schema; a value that does not fit its type is
    NULL and costs nothing else. ``rowkey`` names the column that receives the
    message key, ``document`` the one that keeps the whole text. ``match='sql'``
    resolves names like unquoted SQL identifiers (exact upper case, then any
    case). ``types`` overrides the logical type used for coercion, for types
    Spark has no name for (``{'a': 'uint32'}``). ``skip_rejects`` leaves out payloads
    that are no documents instead of giving them a row of NULLs.
    """
    if match not in MATCH_RULES:
        raise ValueError(f"unknown match rule {match!r}; expected one of {MATCH_RULES}")
    schema = StructType.fromDDL(columns) if isinstance(columns, str) else columns
    names = [field.name for field in schema]
    kept = [F.col(name) for name in keep]
    if rowkey:
        kept.append(F.col("key").alias(rowkey))
    if document:
        kept.append(F.col("value").alias(document))
    held = list(keep) + [name for name in (rowkey, document) if name]
    raw = [f"_raw_{position}" for position in range(len(names))]
    source = messages.select(*kept, F.col("value").alias("_text"))
    if match == "exact":
        if skip_rejects:
            source = source.where(is_document(F.col("_text")))
        texts = extract_fields(source, dict(zip(raw, names)), held, "_text")
    else:
        texts = _extract_sql_names(source, dict(zip(raw, names)), held, skip_rejects)
    overrides = types or {}
    return texts.select(
        *held,
        *[
            coerce(
                null_text(F.col(alias)),
                overrides.get(field.name, field.dataType.simpleString()),
                mode,
            ).alias(field.name)
            for alias, field in zip(raw, schema)
        ],
    )


def _extract_sql_names(
    source: DataFrame, wanted: Mapping[str, str], held: Sequence[str], skip_rejects: bool
) -> DataFrame:
    """``extract_fields`` with the spelling of each name looked up per document.

    A first pass lists the keys, a second reads the values. Both are done once per
    row: nothing can be pushed through the generator that makes the values.
    """
    spelled = source.withColumn("_keys", F.json_object_keys("_text"))
    if skip_rejects:
        spelled = source.where(is_document(F.col("_text"))).withColumn(
            "_keys", F.json_object_keys("_text")
        )
    keys = [f"_key_{position}" for position in range(len(wanted))]
    named = spelled.select(
        *held,
        "_text",
        *[
            spelled_key(F.col("_keys"), name).alias(key)
            for key, name in zip(keys, wanted.values())
        ],
    )
    values = F.call_function("json_tuple", F.col("_text"), *[F.col(key) for key in keys])
    return named.select(*held, values.alias(*wanted))


def only_documents(messages: DataFrame) -> DataFrame:
    """Messages whose payload is a JSON object; the rest is skipped."""
    return messages.where(is_document(F.col("value")))


def rejects(
    messages: DataFrame, include_value: bool = False, whole: bool = False
) -> DataFrame:
    """Where and why payloads were rejected.

    The text itself is left out unless asked for: it may be sensitive. ``whole`` lists
    what the extended documents leave out, texts with a second document included.
    """
    columns = ["partition", "offset", "reason"] + (["value"] if include_value else [])
    return (
        messages.withColumn("reason", reject_reason(F.col("value"), whole))
        .where(F.col("reason").isNotNull())
        .select(*columns)
    )
