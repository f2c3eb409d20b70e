"""The play load as a triggered stream over the raw zone."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from strata.operators.clean import clean_plays
from strata.operators.gate import GatePolicy, NullStats
from strata.plans.load import Run, gated_new_rows
from strata.sources.files import read_layer, read_plays, write_parquet
from strata.staging import file_system, make_folder, path_exists


def stream_plays(
    spark: SparkSession,
    raw: str,
    gold: str,
    play_table,
    checkpoint: str,
    keys: Sequence[str] = ("id",),
    policy: GatePolicy = GatePolicy(),
    uri_prefix: str = "",
    salts: int | None = 1,
    rejects: str | None = None,
    max_files: int | None = None,
) -> NullStats | None:
    """Load the files of ``raw`` that earlier runs have not seen, and return the gate's counts, None if there are none.

    The checkpoint remembers the files, so nothing has to be moved out of the zone between runs. The stream only lands:
    the cleaned rows of micro-batch n replace ``gold/batch_id=n``, whatever schemas its files have. When it has seen all
    files, what landed is loaded as :func:`strata.plans.play.load_plays` loads it: against the keys stored before the run,
    through one gate. How files are dealt to micro-batches (``max_files``) therefore changes no result. Batches are marked as
    loaded beside the checkpoint; a run that breaks off while it loads is completed by the next one, before new files.
    """
    play_table.create(spark)
    make_folder(spark, raw)
    marks = f"{checkpoint}_loaded"

    def land(files: DataFrame, batch_id: int) -> None:
        # The batch's own session, which holds the settings of the stream. Paths only: the files are read as a batch.
        paths = [r.path for r in files.select("path").toLocalIterator()]
        if paths:
            plays = clean_plays(read_plays(files.sparkSession, paths, uri_prefix))
            write_parquet(plays, f"{gold}/batch_id={batch_id}")

    def load() -> NullStats | None:
        batches = [b for b in _batches(spark, gold) if not path_exists(spark, f"{marks}/{b}")]
        if not batches:
            return None
        plays = read_layer(spark, [f"{gold}/batch_id={b}" for b in batches], "gold_play")
        gate = lambda staging: gated_new_rows(plays, play_table, keys, staging, "play_keys", policy, salts=salts)
        run = Run(spark, f"stream-{zlib.crc32(checkpoint.encode()):08x}-{batches[0]}-{batches[-1]}", rejects)
        stats = run.decide({"plays": gate}, {"plays": play_table})
        run.store("plays", play_table)
        for b in batches:
            make_folder(spark, f"{marks}/{b}")
        run.close()
        return stats["plays"]

    load()
    files = spark.readStream.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    files = files.option("maxFilesPerTrigger", max_files) if max_files else files
    files = files.schema("path string, modificationTime timestamp, length long, content binary")
    writer = files.load(raw).select("path").writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    return load()


def _batches(spark: SparkSession, gold: str) -> list[int]:
    """Numbers of the micro-batches that have landed."""
    if not path_exists(spark, gold):
        return []
    fs, p = file_system(spark, gold)
    names = (s.getPath().getName() for s in fs.listStatus(p))
    found = (n.removeprefix("batch_id=") for n in names if n.startswith("batch_id="))
    return sorted(int(n) for n in found if path_exists(spark, f"{gold}/batch_id={n}/_SUCCESS"))
