"""Structured records: ordered flattening, aliases to canonical fields, confidence, decision messages."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType

from quillmill.functions import text as T
from quillmill.functions import vocab

#: Field group -> hundredths of confidence that any present value of the group is worth.
WEIGHTS = {("symbol",): 20, ("timeframe",): 15, ("direction",): 20, ("entry",): 15, ("thesis", "notes"): 15, ("outcome", "pnl"): 15}
LEAST = 0.35


def _lines(value) -> list[str]:
    """``path: value`` of every leaf, in order; a stack holds what is still to be opened."""
    out, todo = [], [("", value)]
    while todo:
        path, v = todo.pop()
        if isinstance(v, dict):
            todo += [(f"{path}.{k}" if path else str(k), x) for k, x in reversed(v.items())]
        elif isinstance(v, list):
            todo += [(f"{path}[{i}]", x) for i, x in reversed([*enumerate(v)])]
        else:
            shown = "" if v is None else str(v)
            out.append(f"{path}: {shown}" if path else shown)
    return out


@F.pandas_udf(ArrayType(StringType()))
def flatten_json(payloads: pd.Series) -> pd.Series:
    """``path: value`` lines of a JSON text in its own order; null for what isn't JSON."""

    def one(p):
        try:
            return _lines(json.loads(p)) if p is not None else None
        except ValueError:
            return None

    return payloads.map(one)


def _canonical(payload: str | None) -> dict[str, str] | None:
    try:
        got = json.loads(payload) if payload is not None else None
    except ValueError:
        return None
    if not isinstance(got, dict) or not got:
        return None
    low = {str(k).lower(): v for k, v in got.items()}
    out = {}
    for field, names in (*vocab.RECORD_FIELDS.items(), *((p, (p,)) for p in vocab.PASSED_FIELDS)):
        value = next((low[n] for n in names if low.get(n) not in (None, "", [])), None)
        if value is not None:
            out[field] = json.dumps(value, ensure_ascii=False)
    return out


@F.pandas_udf(MapType(StringType(), StringType()))
def normalize_record(payloads: pd.Series) -> pd.Series:
    """Canonical field -> JSON of the first alias with a value; keys apart from case, the last of equals wins."""
    return payloads.map(_canonical)


def normalize_columns(fields: dict[str, Column]) -> Column:
    """The same map from plain string columns, without leaving the JVM."""
    low = {k.lower(): v for k, v in fields.items()}
    pairs = []
    for field, names in (*vocab.RECORD_FIELDS.items(), *((p, (p,)) for p in vocab.PASSED_FIELDS)):
        have = [F.when(low[n] != "", F.to_json(F.struct(low[n].alias("v")))) for n in names if n in low]
        if have:
            pairs += [F.lit(field), F.regexp_extract(F.coalesce(*have), r'(?s)^\{"v":(.*)\}$', 1)]
    return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())


def truthy(value: Column) -> Column:
    """Of a JSON text: everything but null, false, zero and the empty."""
    return value.isNotNull() & ~value.rlike(r'^(null|false|""|\[\]|\{\}|-?0+(\.0+)?)$')


def confidence(record: Column) -> Column:
    """Sum of the weights of the groups with a truthy value, in hundredths until the last division."""
    parts = []
    for names, w in WEIGHTS.items():
        have = F.lit(False)
        for n in names:
            have = have | truthy(F.try_element_at(record, F.lit(n)))
        parts.append(F.when(have, w).otherwise(0))
    return sum(parts, F.lit(0)) / 100


def plain(value: Column) -> Column:
    return F.when(value.startswith('"'), F.get_json_object(F.concat(F.lit('{"v":'), value, F.lit("}")), "$.v")).otherwise(value)


# The instructions of a decision example, and the fields that would give its end away.
SYSTEM = "You are a trading backtesting assistant. Use only the provided context and respond with a compact decision summary."
REVIEW = "Review this historical trade setup and state the intended decision.\n\n"
HINDSIGHT = ("outcome", "pnl", "end_time")


@F.pandas_udf(StringType())
def _indented(objects: pd.Series) -> pd.Series:
    return objects.map(lambda o: json.dumps(json.loads(o), ensure_ascii=False, indent=2), na_action="ignore")


def _pairs(record: Column, indent: str) -> Column:
    return F.transform(F.map_entries(record), lambda e: F.concat(F.lit(f'{indent}"'), e["key"], F.lit('": '), e["value"]))


def _nested(record: Column) -> Column:
    """A map of JSON values on one line, if any is a list or object that holds something."""
    deep = F.exists(F.map_values(record), lambda v: v.rlike(r"^[\[{].*[^\[{]"))
    return F.when(deep, F.concat(F.lit("{"), F.array_join(_pairs(record, ""), ","), F.lit("}")))


def _flat(record: Column) -> Column:
    return F.when(F.size(record) == 0, "{}").otherwise(F.concat(F.lit("{\n"), F.array_join(_pairs(record, "  "), ",\n"), F.lit("\n}")))


def decision_messages(record: Column, nested: bool = True) -> Column:
    """System, user and assistant messages; null without a symbol and a direction or entry, or without anything to reply.

    The prompt is the record but for what was known only afterwards; the reply holds action (the direction), entry, stop_loss,
    take_profit and thesis (else the notes), those that have a value. Both are JSON texts, two blanks a level. Records with lists or
    objects inside leave the JVM for that; ``nested=False`` where none has. The record is bound to a variable and so worked out once
    (once more for each of the two texts where ``nested``), as Spark finds no common parts in expressions with lambdas.
    """

    def asked(r: Column) -> Column:
        return F.map_filter(r, lambda k, v: ~k.isin(*HINDSIGHT))

    def reply(r: Column) -> Column:
        get = lambda n: F.try_element_at(r, F.lit(n))
        thesis = F.when(truthy(get("thesis")), get("thesis")).otherwise(get("notes"))
        given = {"action": get("direction"), "entry": get("entry"), "stop_loss": get("stop_loss"), "take_profit": get("take_profit"), "thesis": thesis}
        return F.map_filter(F.create_map(*(x for k, v in given.items() for x in (F.lit(k), v))), lambda k, v: v.isNotNull() & ~v.isin("null", '""'))

    def messages(r: Column, asked_: Column, reply_: Column) -> Column:
        has = lambda n: truthy(F.try_element_at(r, F.lit(n)))
        message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
        told = lambda x: F.when(F.size(x) > 0, F.array(
            message("system", F.lit(SYSTEM)), message("user", F.concat(F.lit(REVIEW), F.coalesce(asked_, T.let(asked(r), _flat)))), message("assistant", F.coalesce(reply_, _flat(x)))
        ))
        return F.when(has("symbol") & (has("direction") | has("entry")), T.let(reply(r), told))

    if not nested:
        return T.let(record, lambda r: messages(r, F.lit(None).cast("string"), F.lit(None).cast("string")))
    deep = lambda part: _indented(T.let(record, lambda r: T.let(part(r), _nested)))
    return T.let(F.struct(record.alias("r"), deep(asked).alias("asked"), deep(reply).alias("reply")), lambda x: messages(x["r"], x["asked"], x["reply"]))


def trade_candidates(rows: DataFrame, record: Column, least: float = LEAST) -> DataFrame:
    """Rows whose record reaches the least confidence, for review; columns of ``rows`` stay."""
    got = rows.withColumn("normalized_record", record).withColumn("confidence", confidence(F.col("normalized_record")))
    return got.where(F.col("confidence") >= least).withColumn("review_required", F.lit(True)).withColumn("messages", decision_messages(F.col("normalized_record")))


def payload_text(rows: DataFrame, payload: str) -> DataFrame:
    return rows.withColumn("text", F.array_join(flatten_json(F.col(payload)), "\n")).withColumn("record_id", T.stable_id("record", F.col(payload)))
