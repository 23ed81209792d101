import json

from pyspark.sql import functions as F

from anchorline.functions.tree import Caps, sanitised_json


def brute(v, caps, depth=0):
    if depth > caps.depth:
        return "…"
    if v is None or isinstance(v, bool | int | float):
        return v
    if isinstance(v, bytes | bytearray):
        return {"_type": "bytes", "size": len(v), "note": "binary omitted from log"}
    if isinstance(v, str):
        return v if len(v) <= caps.text else v[: caps.text] + f"\n… ({len(v) - caps.text} more chars)"
    if isinstance(v, dict):
        out = {str(k): brute(x, caps, depth + 1) for k, x in list(v.items())[: caps.items]}
        return out | ({"…": f"({len(v) - caps.items} more keys)"} if len(v) > caps.items else {})
    out = [brute(x, caps, depth + 1) for x in v[: caps.items]]
    return out + ([f"… ({len(v) - caps.items} more items)"] if len(v) > caps.items else [])


def test_trees(spark):
    rows = [
        {"s": 'a "long" text\né\U0001f600', "n": 1.5, "b": True, "raw": b"12345", "l": [{"x": "one", "m": {"k": [1, 2, 3]}}, None, {"x": None, "m": {}}, {"x": "four", "m": None}], "deep": [[[["bottom"]]]]},
        {"s": None, "n": None, "b": None, "raw": None, "l": [], "deep": None},
        {"s": "", "n": -0.25, "b": False, "raw": b"", "l": None, "deep": [[], [[]], [[["x"], ["y"], ["z"], ["w"]]]]},
    ]
    schema = "s string, n double, b boolean, raw binary, l array<struct<x:string,m:map<string,array<int>>>>, deep array<array<array<array<string>>>>"
    df = spark.createDataFrame(rows, schema)
    whole = F.struct(*df.columns)
    kind = df.select(whole.alias("v")).schema["v"].dataType
    for caps in (Caps(), Caps(text=4, items=2, depth=3), Caps(text=4, items=1, depth=1), Caps(items=3, depth=4)):
        got = [json.loads(r.j) for r in df.select(sanitised_json(whole, kind, caps).alias("j")).collect()]
        assert got == [brute(r, caps) for r in rows], caps
