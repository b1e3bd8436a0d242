"""Agent configuration (S6, S7): a small JSON list of name / email / phone.

The config is a handful of rows, so it is read on the driver like any config
file and handed to Spark as a tiny broadcastable frame with an ``ordinal``
column that keeps the configured order.
"""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_HERE = Path(__file__).resolve().parent
EXAMPLE_FILE = _HERE / "agents.example.json"
AGENTS_ENV = "CARELEDGER_AGENTS_FILE"

AGENT_SCHEMA = T.StructType([
    T.StructField("ordinal", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("email", T.StringType(), False),
    T.StructField("phone", T.StringType(), True),
])


def load_agents(path: str | os.PathLike | None = None) -> list[dict]:
    """Agents of the given file, else of $CARELEDGER_AGENTS_FILE, else of the bundled example, in file order.

    A file that was named but is not there, or has no usable agent, is an error: a silent fallback would
    filter the real agents' rows away.
    """
    named = path or os.environ.get(AGENTS_ENV) or EXAMPLE_FILE
    entries = json.loads(Path(named).read_text(encoding="utf-8")).get("agents") or []
    lacking = [e for e in entries if not (e.get("name") and e.get("email"))]
    if lacking or not entries:
        raise ValueError(f"{named}: " + (f"agents without name or email: {lacking}" if lacking else "no agents"))
    return [dict(ordinal=n, name=e["name"], email=e["email"], phone=e.get("phone") or None) for n, e in enumerate(entries, 1)]


def agents_frame(spark: SparkSession, agents: list[dict] | None = None) -> DataFrame:
    keys = AGENT_SCHEMA.fieldNames()
    return spark.createDataFrame([tuple(a[k] for k in keys) for a in (load_agents() if agents is None else agents)], AGENT_SCHEMA)


def agents_of(frame: DataFrame) -> list[dict]:
    """The list behind an agents frame (configuration: a handful of rows)."""
    return [r.asDict() for r in frame.select(*AGENT_SCHEMA.fieldNames()).orderBy("ordinal").collect()]


def agent_emails(agents: list[dict]) -> list[str]:
    return [a["email"] for a in agents]


def agent_phones(agents: list[dict]) -> list[str]:
    return [a["phone"] for a in agents if a["phone"]]
