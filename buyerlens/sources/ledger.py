"""Deliveries of landing files, and the ledger of which one each stored month is made of.

A landing folder of a month holds deliveries, and a delivery replaces the whole month. A file name may carry the number of
its delivery and the part it is of a declared number of parts: ``orders-d0007-p2of3.csv``. All files of one Spark write are
one delivery; any other file is one of its own. A delivery whose declared parts are not all there is
not taken yet. Of the whole ones the greatest counts: numbered ones by number, whatever their files'
times say, after unnumbered ones, which go by time and name.

What was taken is written to a versioned table together with its delivery, number and files: rows and ledger are one
commit. The stream and the batch both bring months up to date by :func:`refresh`, from a listing of the landing folders and
the ledger alone, so they agree, and running again changes nothing. A late part of an older delivery, an
older delivery and a copied file leave a month as it is."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from buyerlens.contracts import CONTRACTS, INCREMENTAL_DATASETS
from buyerlens.session import first_line, listed
from buyerlens.sources.versions import VersionedTable

#: Names of landing files; a copy such as ``orders.csv.bak`` is none.
LANDED = re.compile(r"\.csv(\.(gz|bz2|zst|lz4|snappy|deflate))?$")
_SPARK = re.compile(r"^part-\d+-(.+?)(-c\d+)?$")
_DECLARED = re.compile(r"^(?P<stem>.*?)(-d(?P<number>\d+))?(-p(?P<part>\d+)of(?P<parts>\d+))?$")
SNAPSHOT = "full"


@dataclass(frozen=True)
class Delivery:
    """Files of one delivery; ``number`` is None and ``parts`` 0 where the names do not say."""

    name: str
    number: int | None
    parts: int
    files: tuple[tuple[str, int], ...]
    part_numbers: frozenset[int] = frozenset()

    @property
    def whole(self) -> bool:
        return not self.parts or len(self.part_numbers) >= self.parts

    @property
    def rank(self) -> tuple:
        newest = max(time for _, time in self.files)
        return (0, newest, self.name) if self.number is None else (1, self.number, self.name)


def deliveries(files: Iterable[tuple[str, int]]) -> list[Delivery]:
    """The deliveries that ``(name, time)`` of the files of one folder make up."""
    found: dict[tuple, dict] = {}
    for name, time in files:
        if not LANDED.search(name):
            continue
        stem = LANDED.sub("", name)
        written = _SPARK.match(stem)
        said = _DECLARED.match(written[1] if written else stem)
        number, parts = said["number"] and int(said["number"]), int(said["parts"] or 0)
        one = found.setdefault((said["stem"], number, parts), {"files": [], "numbers": set()})
        one["files"].append((name, time))
        if said["part"]:
            one["numbers"].add(int(said["part"]))
    return [
        Delivery(stem if number is None else f"{stem}-d{number}", number, parts, tuple(sorted(one["files"])), frozenset(one["numbers"]))
        for (stem, number, parts), one in found.items()]


def chosen(files: Iterable[tuple[str, int]]) -> Delivery | None:
    """The whole delivery that counts, if there is one."""
    return max((d for d in deliveries(files) if d.whole), key=lambda d: d.rank, default=None)


def dataset_store(spark: SparkSession, processed: str, dataset: str) -> VersionedTable:
    """Stored months of a dataset, or the customer snapshot, with the delivery that each is made of."""
    schema = CONTRACTS[dataset].landing_schema
    if dataset in INCREMENTAL_DATASETS:
        schema = schema.add("year", "integer").add("month", "integer")
    return VersionedTable(spark, f"{processed}/{dataset}", schema, dataset)


def month_name(year: int, month: int) -> str:
    return f"{year:04d}-{month:02d}"


def _folder(landing: str, dataset: str, partition: str) -> str:
    if partition == SNAPSHOT:
        return f"{landing}/{dataset}/snapshot={SNAPSHOT}"
    return f"{landing}/{dataset}/year={partition[:4]}/month={partition[5:]}"


def _is_news(delivery: Delivery, stored: Row | None) -> bool:
    """Whether a delivery changes what is stored: it is a greater one, or has other files or times than before."""
    if stored is None:
        return True
    facts = stored["facts"]
    before = (1, int(facts["number"]), facts["delivery"]) if facts["number"] else (0, int(facts["time"]), facts["delivery"])
    if delivery.rank < before and delivery.name != facts["delivery"]:
        return False
    return _files_text(delivery) != facts["files"]


def _files_text(delivery: Delivery) -> str:
    return "\n".join(f"{name}\t{time}" for name, time in delivery.files)


def refresh(spark: SparkSession, landing: str, processed: str, dataset: str, partitions: Iterable[str]) -> dict[str, Row]:
    """Bring the named months, or the snapshot, up to what has landed; return the commits of all that is stored then.

    Only their landing folders are listed. All changed months are written by one job and committed together."""
    store = dataset_store(spark, processed, dataset)
    seen, news = store.snapshot(), {}
    for name in partitions:
        delivery = chosen(listed(spark, _folder(landing, dataset, name)) or [])
        if delivery and _is_news(delivery, seen.live.get(name)):
            news[name] = delivery
    made: list[Row] = []
    if news:
        rows = _read(spark, landing, dataset, news)
        monthly = dataset in INCREMENTAL_DATASETS
        part = F.format_string("%04d-%02d", "year", "month") if monthly else F.lit(SNAPSHOT)
        made = store.write_parts(rows, part, {
            name: {"delivery": d.name, "number": None if d.number is None else str(d.number), "parts": str(d.parts),
                   "time": str(max(t for _, t in d.files)), "files": _files_text(d)}
            for name, d in news.items()}, seen)
    return seen.live | {commit["partition"]: commit for commit in made}


def _read(spark: SparkSession, landing: str, dataset: str, news: dict[str, Delivery]) -> DataFrame:
    """Rows of the deliveries under the contract's columns, found by the names in their headers.

    Parts of a delivery share a header; a part with another one is an error. Deliveries of one header are read together."""
    contract = CONTRACTS[dataset].landing_schema
    by_header: dict[tuple[str, ...], list[str]] = {}
    for name, delivery in news.items():
        folder = _folder(landing, dataset, name)
        header = next(csv.reader([first_line(spark, f"{folder}/{delivery.files[0][0]}")]), [])
        if absent := [c for c in contract.names if c not in header]:
            raise ValueError(f"{dataset} {name}: delivery {delivery.name} lacks {', '.join(absent)}")
        by_header.setdefault(tuple(header), []).extend(f"{folder}/{file}" for file, _ in delivery.files)
    types = {f.name: f.dataType for f in contract}
    monthly = dataset in INCREMENTAL_DATASETS
    frames = []
    for header, paths in by_header.items():
        schema = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
        if monthly:
            schema = schema.add("year", "integer").add("month", "integer")
        rows = (
            spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("escape", '"')
            .option("basePath", f"{landing}/{dataset}").csv([_literal(p) for p in paths]))
        frames.append(rows.select(*contract.names, *(["year", "month"] if monthly else [])))
    return reduce(DataFrame.unionByName, frames)


def _literal(path: str) -> str:
    """A path whose name holds signs that file patterns are made of."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)
