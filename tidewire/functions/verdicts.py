"""Verdicts read out of a classifier's free-text reply."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.functions.basics import bind

_VERDICT_TYPE = "struct<is_noise:boolean,reason:string,category:string>"


def fallback_verdict() -> Column:
    return F.struct(
        F.lit(True).alias("is_noise"),
        F.lit("fallback").alias("reason"),
        F.lit(None).cast("string").alias("category"),
    ).cast(_VERDICT_TYPE)


def json_block(reply: Column) -> Column:
    """From the first `{` to the last `}`, with every apostrophe made a double quote; else NULL."""
    start = F.instr(reply, "{")
    after_last = F.length(F.substring_index(reply, "}", -1))
    length = F.length(reply) - after_last - start + 1
    found = F.contains(reply, F.lit("{")) & F.contains(reply, F.lit("}")) & (length > 0)
    return F.when(found, F.replace(F.substring(reply, start, length), F.lit("'"), F.lit('"')))


def _whole_json(text: Column) -> Column:
    """VARIANT of a text that is exactly one JSON value, else NULL.

    The parser stops after the first value, so the text is read as the only element of an array.
    """
    items = F.try_variant_get(
        F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>"
    )
    return bind(items, lambda x: F.when(F.size(x) == 1, F.get(x, F.lit(0))))


def _truthy(value: Column) -> Column:
    """A missing flag is true; null, empty and zero values are false; any other value is true."""
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    return (
        F.when(value.isNull(), True)
        .when(F.is_variant_null(value), False)
        .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when(kind == "STRING", text != "")
        .when(kind.startswith("ARRAY"), text != "[]")
        .when(kind.startswith("OBJECT"), text != "{}")
        .otherwise(F.coalesce(F.try_variant_get(value, "$", "double") != 0, F.lit(True)))
    )


def _reason(value: Column, chars: int | None) -> Column:
    text = F.try_variant_get(value, "$", "string")
    shown = (
        F.when(value.isNull(), F.lit("unknown"))
        .when(F.is_variant_null(value), F.lit("None"))
        .when(F.schema_of_variant(value) == "BOOLEAN", F.initcap(text))
        .otherwise(text)
    )
    return shown if chars is None else F.substring(shown, 1, chars)


def _category(value: Column) -> Column:
    """Missing gives `unknown`, an explicit null stays NULL."""
    return F.when(value.isNull(), F.lit("unknown")).otherwise(F.try_variant_get(value, "$", "string"))


def _verdict(item: Column, reason_chars: int | None) -> Column:
    def field(name: str) -> Column:
        return F.try_variant_get(item, f"$.{name}", "variant")

    return F.struct(
        bind(field("is_noise"), _truthy).alias("is_noise"),
        bind(field("reason"), lambda v: _reason(v, reason_chars)).alias("reason"),
        bind(field("category"), _category).alias("category"),
    ).cast(_VERDICT_TYPE)


def parse_verdicts(
    reply: Column, batch_size: Column | int, reason_chars: int | None = None
) -> Column:
    """array<struct<is_noise, reason, category>> with one verdict per article of the batch.

    Short result lists are filled with the fallback. A reply that is no JSON, or has a result that is
    no object, gives the fallback for the whole batch.
    """
    n = F.lit(batch_size) if isinstance(batch_size, int) else batch_size
    everything = F.array_repeat(fallback_verdict(), n)

    def read(results: Column) -> Column:
        used = F.slice(results, 1, F.greatest(n, F.lit(0)))
        broken = F.exists(
            used, lambda r: ~F.coalesce(F.schema_of_variant(r).startswith("OBJECT"), F.lit(False))
        )
        filled = F.concat(
            F.transform(used, lambda r: _verdict(r, reason_chars)),
            F.array_repeat(fallback_verdict(), F.greatest(n - F.size(used), F.lit(0))),
        )
        return F.when(results.isNull() | broken, everything).otherwise(filled)

    results = F.try_variant_get(_whole_json(json_block(reply)), "$.results", "array<variant>")
    return F.when(reply.isNull(), everything).otherwise(bind(results, read))


def parse_verdict(reply: Column, reason_chars: int | None = None) -> Column:
    """The verdict of a one-article batch; its reason is whole unless `reason_chars` is given."""
    return F.get(parse_verdicts(reply, 1, reason_chars), F.lit(0))


def reply_as_json(reply: Column) -> Column:
    """The reply as VARIANT; text that is no JSON is wrapped as `{"raw": text}`."""
    wrapped = F.to_variant_object(F.struct(reply.alias("raw")))
    return F.coalesce(_whole_json(reply), wrapped)
