"""Tables whose parts are replaced all at once.

Every write goes to a folder of its own. Which folders make up the table is said by one small file, and a commit replaces that file:
a reader sees the table before a commit or after it, and a write that fails half way leaves it as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from loadcycle.sources.scratch import read_text, remove, shuffles_released, write_text

FILE = "_current.json"


@dataclass(frozen=True)
class Version:
    """The folders of a table's parts by name, what is told of each part, and the table's schema."""

    number: int = 0
    parts: Mapping[str, str] = field(default_factory=dict)
    told: Mapping[str, object] = field(default_factory=dict)
    schema: Mapping[str, object] | None = None


def current(spark: SparkSession, path: str) -> Version:
    """The last commit; an empty version if there is none."""
    told = read_text(spark, f"{path.rstrip('/')}/{FILE}")
    return Version() if told is None else Version(**json.loads(told))


def stage_part(df: DataFrame, path: str, part: str, partition_by: Iterable[str] = ()) -> str:
    """Writes the rows of a part to a folder that no reader knows yet, and gives its name."""
    folder = f"{part}-{uuid.uuid4().hex}"
    with shuffles_released(df.sparkSession):
        df.write.mode("errorifexists").partitionBy(*partition_by).parquet(f"{path.rstrip('/')}/{folder}")
    return folder


def commit(
    spark: SparkSession, path: str, parts: Mapping[str, str | None], schema: T.StructType, told: Mapping[str, object] | None = None,
    whole: bool = False,
) -> Version:
    """Makes staged folders the table's parts; None takes a part away. ``whole`` takes away all that are not named.

    Two commits at the same time are not kept apart: one run writes a table.
    """
    before = current(spark, path)
    kept = {} if whole else dict(before.parts)
    kept.update(parts)
    said = {**before.told, **(told or {})}
    now = {p: f for p, f in sorted(kept.items()) if f is not None}
    after = Version(before.number + 1, now, {p: said[p] for p in now if p in said}, schema.jsonValue())
    write_text(spark, f"{path.rstrip('/')}/{FILE}", json.dumps(asdict(after)))
    return after


def read(spark: SparkSession, path: str, parts: Iterable[str] | None = None) -> DataFrame:
    """The rows of the last commit, or of some of its parts; a part that it lacks has no rows."""
    version = current(spark, path)
    if version.schema is None:
        raise ValueError(f"{path} has no commit")
    schema = T.StructType.fromJson(version.schema)
    named = version.parts if parts is None else [p for p in parts if p in version.parts]
    folders = [f"{path.rstrip('/')}/{version.parts[p]}" for p in named]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def replace(df: DataFrame, path: str) -> DataFrame:
    """The rows in place of the whole table, at once."""
    spark = df.sparkSession
    commit(spark, path, {"all": stage_part(df, path, "all")}, df.schema, whole=True)
    return read(spark, path)


def clean(spark: SparkSession, path: str) -> list[str]:
    """Removes folders that the last commit does not name: old versions and what failed writes left. No reader may be under way."""
    kept = {folder.split("/")[0] for folder in current(spark, path).parts.values()} | {FILE}
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    gone = [n for n in (s.getPath().getName() for s in store.listStatus(place)) if n not in kept and not n.endswith(".crc")]
    for name in gone:
        remove(spark, f"{path.rstrip('/')}/{name}")
    return sorted(gone)
