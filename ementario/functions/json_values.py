"""JSON text that must be one value and nothing else."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

STRICT = {"allowSingleQuotes": "false"}


def one_value(text: Column, shape: str) -> Column:
    """``struct(value, whole)``: the value read as ``shape``, and whether the text was one JSON value from its start to its end.

    Spark's reader stops at the end of a value. So the text is put into an object between its first key and an end mark that
    nobody can know beforehand: if anything but one value stands there, the object has other keys than these two.
    """
    end = f"fim_{uuid.uuid4().hex}"
    wrapped = F.concat(F.lit('{"v":'), text, F.lit(f',"{end}":1}}'))
    parsed = F.from_json(wrapped, f"v {shape}, {end} int", STRICT)
    both = F.array(F.struct(parsed.alias("p"), F.json_object_keys(wrapped).alias("keys")))
    # A lambda variable, so that each text is parsed once.
    return F.transform(both, lambda r: F.struct(
        r["p"]["v"].alias("value"), (r["p"][end].isNotNull() & F.coalesce(r["keys"] == F.array(F.lit("v"), F.lit(end)), F.lit(False))).alias("whole")
    ))[0]
