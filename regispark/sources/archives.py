"""Zip archive sources (S8-S11), a member at a time.

A first job reads the central directories, by range reads at the end of each archive, and
lists the members; the list is as long as that of any scan's files. A second one gives every
member a task of its own, which seeks to it and inflates it as a stream. No archive or member
is ever held in memory, none has a size limit, and one archive of many members is read by as
many tasks.

* :func:`read_zip` — members -> typed rows; Python only inflates them into text lines, which
  Spark's own ``from_csv`` parses (JVM-side).
* :func:`extract_archives` — streams members to a target directory in chunks and returns a
  manifest (archive, member, target, bytes, status, error), with optional member filter and
  canonical ``{prefix}{digits}.csv`` renaming. A corrupt archive or member yields an error
  row; the others are still extracted.
"""

from __future__ import annotations

import io
import os
import re
import shutil
import zipfile
import zlib
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ._fs import move, open_output, open_random_access
from .delimited import spark_charset

MANIFEST = "archive string, member string, target string, bytes long, status string, error string"
CHUNK = 1 << 20
#: What a damaged, truncated or encrypted archive, or a wrong charset, raises.
ARCHIVE_ERRORS = (zipfile.BadZipFile, zlib.error, EOFError, OSError, RuntimeError, NotImplementedError, UnicodeDecodeError)


def canonical_name(archive: str, member: str) -> str:
    """``Estabelecimentos3.zip`` -> ``Estabelecimentos3.csv`` (prefix + shard digits)."""
    stem = os.path.splitext(os.path.basename(archive))[0]
    m = re.match(r"^([A-Za-z]+)(\d*)$", stem)
    return f"{m.group(1)}{m.group(2)}.csv" if m else os.path.basename(member)


_LISTED = "archive string, place int, member string, size long, error string"
_TASKS = "number long, archive string, place int, member string, target string"


def _members(spark: SparkSession, paths: list[str], member_regex: str | None) -> list:
    """(archive, place, member, size, error) of every file in the archives that matches, in
    order; an archive that cannot be read is a row with an error."""
    def listed(batches):
        rx = re.compile(member_regex) if member_regex else None
        for pdf in batches:
            rows = []
            for archive in pdf["archive"]:
                try:
                    with open_random_access(archive) as raw, zipfile.ZipFile(raw) as zf:
                        rows += [(archive, i, m.filename, m.file_size, None) for i, m in enumerate(zf.infolist())
                                 if not m.is_dir() and (rx is None or rx.search(m.filename))]
                except ARCHIVE_ERRORS as exc:
                    rows.append((archive, None, None, None, f"{type(exc).__name__}: {exc}"))
            yield pd.DataFrame(rows, columns=["archive", "place", "member", "size", "error"])

    if not paths:
        return []
    df = spark.createDataFrame([(p,) for p in paths], "archive string").repartition(len(paths))
    return sorted(df.mapInPandas(listed, _LISTED).collect(), key=lambda r: (r.archive, -1 if r.place is None else r.place))


def _one_each(spark: SparkSession, rows: list[tuple], tasks: int | None = None) -> DataFrame:
    """The members as rows, each in a task of its own (or dealt to ``tasks``)."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], _TASKS)
    return df.repartitionByRange(tasks or max(1, len(rows)), "number")


def _opened(archive: str, place: int):
    """The open archive, and the member at ``place`` of its directory."""
    raw = open_random_access(archive)
    try:
        zf = zipfile.ZipFile(raw)
        return raw, zf, zf.infolist()[int(place)]
    except BaseException:
        raw.close()
        raise


def read_zip(spark: SparkSession, pattern: str, schema: T.StructType, encoding: str = "ISO-8859-1",
             sep: str = ";", member_regex: str | None = None, with_errors: bool = False) -> DataFrame:
    """Every member of every archive matching ``pattern`` as typed rows (+ archive, member).

    A damaged or encrypted archive, or bytes that the charset lacks, fail the job;
    ``with_errors=True`` reads the others instead, and adds an ``error`` column with one row
    per failure (data columns NULL). The archives are listed when this is called."""
    enc = spark_charset(encoding)
    paths = [r.path for r in spark.read.format("binaryFile").load(pattern).select("path").collect()]
    found = _members(spark, sorted(paths), member_regex)
    bad = [r for r in found if r.error]
    if bad and not with_errors:
        raise ValueError(f"{bad[0].archive}: {bad[0].error}")

    def frame(archive, member, line, error=None):
        return pd.DataFrame({"archive": archive, "member": member, "line": line, "error": error}, dtype="object")

    def inflate(batches):
        for pdf in batches:
            for archive, place, member in zip(pdf["archive"], pdf["place"], pdf["member"]):
                try:
                    raw, zf, info = _opened(archive, place)
                    with raw, zf, zf.open(info) as fh:
                        buf = []
                        for line in io.TextIOWrapper(fh, encoding=enc, newline=""):
                            line = line.rstrip("\r\n")
                            if line:
                                buf.append(line)
                            if len(buf) >= 10_000:
                                yield frame(archive, member, buf)
                                buf = []
                        if buf:
                            yield frame(archive, member, buf)
                except ARCHIVE_ERRORS as exc:
                    if not with_errors:
                        raise ValueError(f"{archive}: {type(exc).__name__}: {exc}") from exc
                    yield frame([archive], [member], [None], [f"{type(exc).__name__}: {exc}"])

    members = _one_each(spark, [(r.archive, r.place, r.member, None) for r in found if not r.error])
    lines = members.mapInPandas(inflate, "archive string, member string, line string, error string")
    if bad:
        lines = lines.union(spark.createDataFrame([(r.archive, None, None, r.error) for r in bad], lines.schema))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = lines.select("archive", "member", "error",
                          F.from_csv("line", ddl, {"sep": sep, "quote": '"', "escape": '"'}).alias("__r"))
    out = parsed.select(*[F.col("__r")[f.name].alias(f.name) for f in schema.fields], "archive", "member", "error")
    return out if with_errors else out.drop("error")


def _slots(paths: list[str]) -> list[str]:
    """A folder name for each archive: its stem, with a checksum of the path where stems repeat."""
    stems = [os.path.splitext(os.path.basename(p))[0] for p in paths]
    often = Counter(s.lower() for s in stems)
    return [s if often[s.lower()] == 1 else f"{s}-{zlib.crc32(p.encode()):08x}" for s, p in zip(stems, paths)]


def _member_path(name: str) -> str:
    """The member's path inside its archive, without roots and parent steps."""
    return "/".join(p for p in name.replace("\\", "/").split("/") if p not in ("", ".", ".."))


def extract_archives(spark: SparkSession, paths, target: str, member_filter: str | None = None,
                     rename: bool = False, first_only: bool = False, tasks: int | None = None) -> DataFrame:
    """Extract archives (one task per member, or ``tasks`` in all) into ``target``;
    returns the manifest.

    ``member_filter``: regex a member name must match; ``first_only``: stop after the
    first matching member per archive. Members keep their path below a folder of their
    archive; with ``rename`` they become canonical ``{prefix}{digits}.csv`` files in ``target``
    (``-2``, ``-3`` ... for further members of one archive). No two members share a target:
    archives of the same name get a checksum of their path, and members of one archive whose
    paths coincide are error rows. ``target`` must be a directory every executor can write: a shared mount or a
    filesystem URI (``hdfs://``, ``s3://``, ``gs://``, ``file://``), never a machine-local folder on
    a cluster. The archives are listed when this is called. The manifest is lazy, and each
    action on it extracts anew: write it once.
    """
    paths = list(dict.fromkeys(paths))
    slots = dict(zip(paths, _slots(paths)))

    def place(archive, slot, member, number):
        if not rename:
            return f"{slot}/{_member_path(member)}"
        name = canonical_name(archive, member)
        stem, ext = os.path.splitext(name)
        mark = slot[len(os.path.splitext(os.path.basename(archive))[0]):]
        return f"{stem}{mark}{'' if number == 1 else f'-{number}'}{ext}"

    listed: dict[str, list] = {p: [] for p in paths}
    for r in _members(spark, paths, member_filter):
        listed[r.archive].append(r)
    wanted, manifest = [], []
    for archive, rows in listed.items():
        taken = set()
        if not rows:
            manifest.append((archive, None, None, 0, "no_member", None))
        for number, r in enumerate(rows[:1] if first_only else rows, 1):
            if r.error:
                manifest.append((archive, None, None, 0, "error", r.error))
                continue
            out = target.rstrip("/") + "/" + place(archive, slots[archive], r.member, number)
            if out.lower() in taken:
                manifest.append((archive, r.member, out, 0, "error", "another member has this target"))
                continue
            taken.add(out.lower())
            wanted.append((archive, r.place, r.member, out))

    def extract(batches):
        for pdf in batches:
            rows = []
            for archive, at, member, out in zip(pdf["archive"], pdf["place"], pdf["member"], pdf["target"]):
                try:
                    raw, zf, info = _opened(archive, at)
                    with raw, zf, zf.open(info) as src, open_output(out + ".part") as dst:
                        shutil.copyfileobj(src, dst, CHUNK)
                    move(out + ".part", out)
                    rows.append((archive, member, out, int(info.file_size), "ok", None))
                except ARCHIVE_ERRORS as exc:
                    rows.append((archive, member, None, 0, "error", f"{type(exc).__name__}: {exc}"))
            yield pd.DataFrame(rows, columns=["archive", "member", "target", "bytes", "status", "error"])

    extracted = _one_each(spark, wanted, tasks).mapInPandas(extract, MANIFEST)
    return extracted.union(spark.createDataFrame(manifest, MANIFEST)) if manifest else extracted
