"""Several files as one step: a journal names what a commit adds and removes, and whoever looks next finishes it.

New files are written aside first. Once the journal is there, the commit counts as done: it is carried out, and if that
breaks off, the next one who opens a table carries it out from its start, as each of its moves may be repeated. Without a
journal, nothing of the new files is seen. So a broken run leaves all of its files or none.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from clickloom.sources import files

MOVES_AT_A_TIME = 16


def commit(
    spark: SparkSession, journals: str, staged: str, moves: Iterable[tuple[str, str]], removes: Iterable[str] = ()
) -> None:
    """Move files to their places, delete others, then the folder they were staged in."""
    files.make_folder(spark, journals)
    path = f"{journals}/{uuid.uuid4().hex}.json"
    files.write_text(spark, path, json.dumps({"staged": staged, "moves": list(moves), "removes": list(removes)}))
    finish(spark, path)


def finish(spark: SparkSession, path: str) -> None:
    """Carry out what a journal says, from its start; its first steps may have been taken before."""
    work = json.loads(files.read_text(spark, path))
    with ThreadPoolExecutor(MOVES_AT_A_TIME) as pool:
        list(pool.map(lambda move: files.move(spark, *move), work["moves"]))
        list(pool.map(lambda old: files.delete(spark, old), work["removes"]))
    files.delete(spark, work["staged"])
    files.delete(spark, path)


def finish_all(spark: SparkSession, journals: str) -> None:
    """Finish the commits that broke off."""
    if files.exists(spark, journals):
        for name in files.names(spark, journals):
            if name.endswith(".json"):
                finish(spark, f"{journals}/{name}")
