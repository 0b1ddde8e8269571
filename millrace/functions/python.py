"""Functions that Spark's built-ins can't express, as Arrow-batched pandas UDFs, and registration of user-defined ones.

They are registered under their PostgreSQL names, so translated SQL calls them like any other function.
"""

from __future__ import annotations

import hashlib
import hmac as _hmac
import json
import math
import operator
import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _each(f: Callable, kind: str) -> Callable:
    """A scalar Python function over columns as a pandas UDF; a null argument gives null."""

    def run(*columns: pd.Series) -> pd.Series:
        # Arrow gives a null number as NaN; in a column of objects NaN is a value
        nulls = [c.isna() if c.dtype == object else pd.Series(False, c.index) if c.dtype.kind != "f" else c.isna() for c in columns]
        gone = pd.concat(nulls, axis=1).any(axis=1)
        return pd.Series([None if n else f(*row) for n, row in zip(gone, zip(*columns))], dtype=object)

    wrapped = {1: lambda a: run(a), 2: lambda a, b: run(a, b), 3: lambda a, b, c: run(a, b, c)}[f.__code__.co_argcount]
    wrapped.__annotations__ = {**{n: pd.Series for n in wrapped.__code__.co_varnames[: f.__code__.co_argcount]}, "return": pd.Series}
    return F.pandas_udf(wrapped, kind)


def to_ascii(text: str) -> str:
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()


def hmac(key: str, data: bytes, algorithm: str) -> bytes:
    return _hmac.new(key.encode(), bytes(data), getattr(hashlib, algorithm.lower())).digest()


def contains(whole, part) -> bool:
    """jsonb @>: objects by key, arrays by elements, scalars by value; an array contains a bare scalar."""
    if isinstance(whole, dict) and isinstance(part, dict):
        return all(k in whole and contains(whole[k], v) for k, v in part.items())
    if isinstance(whole, list):
        return all(any(contains(w, p) for w in whole) for p in (part if isinstance(part, list) else [part]))
    return whole == part and isinstance(whole, bool) == isinstance(part, bool)


def jsonb_contains(whole: str, part: str) -> bool:
    return contains(json.loads(whole), json.loads(part))


def jsonb_set(text: str, path: list, fresh: str) -> str:
    value = json.loads(text)
    at = value
    try:
        for key in list(path)[:-1]:
            at = at[int(key)] if isinstance(at, list) else at[key]
        last = path[-1]
        if isinstance(at, list):
            at[int(last)] = json.loads(fresh)
        else:
            at[last] = json.loads(fresh)
    except (KeyError, IndexError, TypeError):
        pass
    return json.dumps(value, separators=(",", ":"), ensure_ascii=False)


def jsonb_delete_path(text: str, path: list) -> str:
    value = json.loads(text)
    at = value
    try:
        for key in list(path)[:-1]:
            at = at[int(key)] if isinstance(at, list) else at[key]
        del at[int(path[-1]) if isinstance(at, list) else path[-1]]
    except (KeyError, IndexError, TypeError):
        pass
    return json.dumps(value, separators=(",", ":"), ensure_ascii=False)


def strip_nulls(value):
    if isinstance(value, dict):
        return {k: strip_nulls(v) for k, v in value.items() if v is not None}
    return [strip_nulls(v) for v in value] if isinstance(value, list) else value


def jsonb_strip_nulls(text: str) -> str:
    return json.dumps(strip_nulls(json.loads(text)), separators=(",", ":"), ensure_ascii=False)


def jsonb_pretty(text: str) -> str:
    return json.dumps(json.loads(text), indent=4, ensure_ascii=False)


STEP = re.compile(r"""\.\*|\.(?P<name>\w+)|\."(?P<quoted>[^"]*)"|\[\*\]|\[(?P<index>-?\d+)\]|\s*\?\s*\((?P<filter>[^()]*)\)""")
COMPARED = {"==": operator.eq, "!=": operator.ne, "<>": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


def passes(item, condition: str) -> bool:
    """A filter: comparisons of @... with a constant, joined by && or ||."""
    for sign, many in (("||", any), ("&&", all)):
        if sign in condition:
            return many(passes(item, part) for part in condition.split(sign))
    m = re.fullmatch(r"\s*@(.*?)\s*(==|!=|<>|<=|>=|<|>)\s*(.+?)\s*", condition)
    if not m:
        raise ValueError(f"unknown filter {condition}")
    want = json.loads(m[3])
    try:
        return any(COMPARED[m[2]](x, want) for x in walked([item], m[1]) if type(x) is type(want) or {type(x), type(want)} == {int, float})
    except TypeError:
        return False


def walked(items: list, path: str) -> list:
    """What a path leads to from the items; lax, as arrays are entered where a member is asked for."""
    at = 0
    while at < len(path):
        m = STEP.match(path, at)
        if not m:
            raise ValueError(f"unknown path {path[at:]!r}")
        at = m.end()
        key = m["name"] if m["name"] is not None else m["quoted"]
        if m["filter"] is not None:
            items = [y for x in items for y in (x if isinstance(x, list) else [x]) if passes(y, m["filter"])]
        elif key is not None:
            items = [y[key] for x in items for y in (x if isinstance(x, list) else [x]) if isinstance(y, dict) and key in y]
        elif m["index"] is not None:
            items = [x[int(m["index"])] for x in items if isinstance(x, list) and -len(x) <= int(m["index"]) < len(x)]
        elif m[0] == "[*]":
            items = [y for x in items for y in (x if isinstance(x, list) else [x])]
        else:
            items = [y for x in items if isinstance(x, dict) for y in x.values()]
    return items


def jsonb_path_found(text: str, path: str) -> list[str]:
    """JSON texts of all that a path finds; a path of the form 'path op constant' finds whether some item passes."""
    body = re.sub(r"^\s*(?:lax|strict)\s+", "", path).strip()
    if re.fullmatch(r"\$[^?]*?\s*(==|!=|<>|<=|>=|<|>)\s*[^()]+", body):
        found: list = [passes(json.loads(text), "@" + body[1:])]
    else:
        found = walked([json.loads(text)], body[1:])
    return [json.dumps(x, separators=(",", ":"), ensure_ascii=False) for x in found]


def encode_escape(data: bytes) -> str:
    return "".join("\\\\" if b == 92 else chr(b) if 0 < b < 128 else f"\\{b:03o}" for b in data)


def decode_escape(text: str) -> bytes:
    return re.sub(rb"\\(\\|[0-3][0-7]{2})", lambda m: b"\\" if m[1] == b"\\" else bytes([int(m[1], 8)]), text.encode())


def set_bit(data: bytes, n: int, bit: int) -> bytes:
    out = bytearray(data)
    out[int(n) // 8] = out[int(n) // 8] & ~(1 << int(n) % 8) | int(bit) << int(n) % 8
    return bytes(out)


def set_byte(data: bytes, n: int, value: int) -> bytes:
    out = bytearray(data)
    out[int(n)] = int(value)
    return bytes(out)


def gamma(x: float) -> float:
    return math.gamma(x)


def lgamma(x: float) -> float:
    return math.lgamma(x)


#: name -> function and Spark type of its result
FUNCTIONS: dict[str, tuple[Callable, str]] = {
    "to_ascii": (to_ascii, "string"), "hmac": (hmac, "binary"), "jsonb_contains": (jsonb_contains, "boolean"), "jsonb_set": (jsonb_set, "string"), "jsonb_delete_path": (jsonb_delete_path, "string"),
    "jsonb_strip_nulls": (jsonb_strip_nulls, "string"), "jsonb_pretty": (jsonb_pretty, "string"), "jsonb_path_found": (jsonb_path_found, "array<string>"), "encode_escape": (encode_escape, "string"), "decode_escape": (decode_escape, "binary"),
    "set_bit": (set_bit, "binary"), "set_byte": (set_byte, "binary"), "gamma": (gamma, "double"), "lgamma": (lgamma, "double"),
}


def install(spark: SparkSession) -> None:
    """Registers the functions of this module in the session."""
    for name, (f, kind) in FUNCTIONS.items():
        spark.udf.register(name, _each(f, kind))


def register_scalar(spark: SparkSession, name: str, f: Callable, returns: str) -> None:
    """CREATE FUNCTION ... LANGUAGE python: called in Arrow batches."""
    spark.udf.register(name, _each(f, returns))


def register_table(spark: SparkSession, name: str, handler: type, returns: str) -> None:
    """A table function from a class with eval()."""
    spark.udtf.register(name, F.udtf(handler, returnType=returns))


def user_aggregate(df: DataFrame, keys: list[str], columns: list[str], state: Callable, accumulate: Callable, merge: Callable, finish: Callable, name: str, returns: str) -> DataFrame:
    """A user-defined aggregate: states are made in each task, in batches, and merged by key, so a hot key meets no single task."""
    import pickle

    key_fields = [df.schema[k] for k in keys]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in key_fields)

    def partial(batches):
        held: dict[tuple, object] = {}
        for batch in batches:
            for row in zip(*(batch[c] for c in [*keys, *columns])):
                key = row[: len(keys)]
                held[key] = accumulate(held[key] if key in held else state(), *row[len(keys) :])
        if held:
            yield pd.DataFrame([(*k, pickle.dumps(v)) for k, v in held.items()], columns=[*keys, "__state"])

    def whole(group: pd.DataFrame) -> pd.DataFrame:
        states = [pickle.loads(s) for s in group["__state"]]
        out = states[0]
        for s in states[1:]:
            out = merge(out, s)
        return pd.DataFrame([(*(group[k].iloc[0] for k in keys), finish(out))], columns=[*keys, name])

    return df.select(*keys, *columns).mapInPandas(partial, f"{kinds}, `__state` binary").groupBy(*keys).applyInPandas(whole, f"{kinds}, `{name}` {returns}")
