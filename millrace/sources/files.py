"""Files as tables and settings: listings, archives, pages of a service, paths (SC4-SC7, SC9-SC12, SC16, SC17, PF24, SF20)."""

from __future__ import annotations

import heapq
import io
import json
import urllib.error
import urllib.request
import zipfile
import zlib
from pathlib import Path
from urllib.parse import urlencode

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from ..functions.scalar import basename, non_blank, strip
from .events import located


def listing(spark: SparkSession, folder: str, patterns: list[str], most: int = 0) -> DataFrame:
    """SC5: path, pattern of the files of each glob pattern, sorted within it; a file is listed for each pattern that it meets. most: 0
    is no limit. Contents are not read."""
    if most < 0:
        raise ValueError("a limit must not be negative")
    found = None
    for k, p in enumerate(patterns):
        below = p.startswith("**/")
        read = spark.read.format("binaryFile").option("pathGlobFilter", p.removeprefix("**/")).option("recursiveFileLookup", str(below).lower())
        part = read.load(folder).select("path", F.lit(k).alias("pattern"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        raise ValueError("a pattern is needed")
    return found.orderBy("pattern", "path").limit(most) if most else found


class ArchiveSource(DataSource):
    """SC7: name, content of the files of a zip archive (ZIP64, too); options path (or URI) and partitions: how many tasks read it. A
    folder named like the archive that holds all files is left out of the names.

    The directory at the archive's end is read once; tasks get ranges of nearly as many compressed bytes, and read those alone.
    """

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return "name string, content binary"

    def reader(self, schema) -> DataSourceReader:
        return _ArchiveReader(self.options)


class Members(InputPartition):
    """(name, place of the local header, compressed bytes, bytes, method, checksum) of some files."""

    def __init__(self, members: list[tuple[str, int, int, int, int, int]]):
        super().__init__(members)
        self.members = members


class Places:
    """An open file that says of a place before its start what files of the operating system say."""

    def __init__(self, file):
        self.file = file

    def seek(self, at: int, whence: int = 0) -> int:
        try:
            return self.file.seek(at, whence)
        except ValueError as e:
            raise OSError(str(e)) from e

    def __getattr__(self, name: str):
        return getattr(self.file, name)


def balanced(sizes: list[int], parts: int) -> list[list[int]]:
    """Numbers of items by part: the largest first, each to the part that has least so far."""
    heap, found = [(0, k) for k in range(parts)], [[] for _ in range(parts)]
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        total, k = heapq.heappop(heap)
        found[k].append(i)
        heapq.heappush(heap, (total + sizes[i], k))
    return [f for f in found if f]


class _ArchiveReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.parts = options["path"], int(options.get("partitions", 4))

    def partitions(self) -> list[InputPartition]:
        system, name = located(self.path)
        with system.open_input_file(name) as f, zipfile.ZipFile(Places(f)) as z:
            infos = [i for i in z.infolist() if not i.is_dir()]
        top = Path(self.path).stem + "/"
        nested = any(i.filename.startswith(top) for i in infos)
        kept = [i for i in infos if not nested or i.filename.startswith(top)]
        for i in kept:
            if i.flag_bits & 1 or i.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
                raise ValueError(f"{i.filename} is encrypted or packed in a way that is not known")
        parts = balanced([i.compress_size + 64 for i in kept], self.parts)
        rows = [[kept[k] for k in sorted(p, key=lambda k: kept[k].header_offset)] for p in parts]
        return [Members([(i.filename.removeprefix(top if nested else ""), i.header_offset, i.compress_size, i.file_size, i.compress_type, i.CRC) for i in p]) for p in rows] or [Members([])]

    def read(self, part: Members):
        system, path = located(self.path)
        if not part.members:
            return
        with system.open_input_file(path) as f:
            for name, at, packed, size, method, checksum in part.members:
                f.seek(at)
                head = f.read(30)
                if head[:4] != b"PK\x03\x04":
                    raise ValueError(f"{name} is not where the directory says")
                f.seek(at + 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little"))
                content = f.read(packed)
                content = zlib.decompress(content, -15) if method == zipfile.ZIP_DEFLATED else content
                if len(content) != size or zlib.crc32(content) != checksum:
                    raise ValueError(f"{name} is damaged")
                yield name, content


class PagesSource(DataSource):
    """SC12: project, task (JSON text) of a service that gives pages of results. Options: base_url, token, project (one, or several by
    commas), page_size, partitions.

    The first page of a project tells how many results there are (count or total); tasks then read ranges of pages. Where it doesn't,
    tasks read every so-many-th page until one is empty, has no next, or is not there. With pushdown=true (and Spark's setting
    spark.sql.python.filterPushdown.enabled) conditions on project choose the projects that are asked for.
    """

    @classmethod
    def name(cls) -> str:
        return "task_pages"

    def schema(self) -> str:
        return "project string, task string"

    def reader(self, schema) -> DataSourceReader:
        return (_AskedReader if self.options.get("pushdown", "false") == "true" else _PagesReader)(self.options)


class Pages(InputPartition):
    """Pages of a project: from, step, and the last one (0: until they end)."""

    def __init__(self, project: str, first: int, step: int, last: int):
        super().__init__((project, first, step, last))
        self.project, self.first, self.step, self.last = project, first, step, last


class _PagesReader(DataSourceReader):
    def __init__(self, options):
        self.url, self.token = options["base_url"].rstrip("/"), options.get("token", "")
        self.projects = [p.strip() for p in options["project"].split(",") if p.strip()]
        self.size, self.parts = int(options.get("page_size", 100)), int(options.get("partitions", 1))

    def partitions(self) -> list[InputPartition]:
        found: list[InputPartition] = []
        for project in self.projects:
            first = self._page(project, 1) if self.parts > 1 else {}
            total = first.get("count", first.get("total"))
            if isinstance(total, int):
                pages = -(-total // self.size)
                edges = [pages * k // self.parts for k in range(self.parts + 1)]
                found += [Pages(project, a + 1, 1, z) for a, z in zip(edges[:-1], edges[1:], strict=True) if a < z]
            else:
                found += [Pages(project, k + 1, self.parts, 0) for k in range(self.parts)]
        return found or [Pages("", 1, 1, -1)]

    def _page(self, project: str, page: int) -> dict:
        """A page; one past the end has no results, whether the service says so or has no such page."""
        query = urlencode({"project": project, "page": page, "page_size": self.size})
        request = urllib.request.Request(f"{self.url}/api/tasks?{query}", headers={"Authorization": f"Token {self.token}"})
        try:
            with urllib.request.urlopen(request, timeout=120) as found:
                return json.load(io.TextIOWrapper(found, "utf-8"))
        except urllib.error.HTTPError as e:
            if e.code == 404 and page > 1:
                return {}
            raise

    def read(self, part: Pages):
        page = part.first
        while part.last >= 0 and (not part.last or page <= part.last):
            found = self._page(part.project, page)
            for r in found.get("results") or []:
                yield part.project, json.dumps(r, ensure_ascii=False)
            if not part.last and (not found.get("results") or not found.get("next")):
                return
            page += part.step


class _AskedReader(_PagesReader):
    """Spark gives it conditions."""

    def pushFilters(self, filters):
        for f in filters:
            wanted = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if wanted is not None and f.attribute == ("project",):
                self.projects = [p for p in self.projects if p in wanted]
            else:
                yield f


def labelled_rows(spark: SparkSession, path: str) -> DataFrame:
    """SC9: image_path, label, label_binary of a JSON array; an item without a path or with another label than accept and reject fails."""
    fields = "imagepath string, image_path string, path string, label string"
    rows = spark.read.schema(fields).option("multiLine", "true").option("mode", "FAILFAST").json(path)
    fail = lambda text: F.raise_error(F.lit(text)).cast("string")
    word = F.lower(strip(F.col("label")))
    label = F.when(word.isin("accept", "reject"), word).otherwise(fail("label must be accept or reject"))
    path_ = F.coalesce(non_blank(F.col("imagepath")), non_blank(F.col("image_path")), non_blank(F.col("path")), fail("an item has no path"))
    return rows.select(path_.alias("image_path"), label.alias("label")).withColumn("label_binary", (F.col("label") == "accept").cast("int"))


def manifest_paths(raw: str | list | None, name: str = "input_manifests") -> list[str]:
    """SC10: one path or a list of them, without blank ones; none at all fails."""
    given = raw if isinstance(raw, list) else [raw]
    found = [str(x).strip() for x in given if x is not None and str(x).strip()]
    if not found:
        raise ValueError(f"{name} must name a manifest")
    return found


def resolve_path(raw: str, base: str, root: str, fallback: str = "base") -> str:
    """SC11: an absolute path as it is; else below the folder of the settings if it is there, else below the root if it is there, else
    below the one named by fallback (base or root)."""
    path = Path(raw.strip())
    if path.is_absolute():
        return str(path)
    near, far = (Path(base) / path).resolve(), (Path(root) / path).resolve()
    return str(near if near.exists() else far if far.exists() or fallback == "root" else near)


def resolved_paths(rows: DataFrame, files: DataFrame, base: str, root: str, column: str = "image_path", fallback: str = "base") -> DataFrame:
    """SC11 for every row: as resolve_path, by a join with the paths of the files that are there (files: path)."""
    raw = strip(F.col(column))
    near, far = F.concat(F.lit(base.rstrip("/") + "/"), raw), F.concat(F.lit(root.rstrip("/") + "/"), raw)
    there = lambda name: files.select(F.col("path").alias(name), F.lit(True).alias(f"{name}_there")).distinct()
    both = rows.withColumns({"_near": near, "_far": far}).join(there("_near"), "_near", "left").join(there("_far"), "_far", "left")
    other = F.col("_far") if fallback == "root" else F.when(F.col("_far_there"), F.col("_far")).otherwise(F.col("_near"))
    path = F.when(raw.startswith("/"), raw).when(F.col("_near_there"), F.col("_near")).otherwise(other)
    return both.withColumn(column, path).select(*rows.columns)


def images_by_name(rows: DataFrame, files: DataFrame, column: str = "image") -> DataFrame:
    """SC16: rows with image_path, the file of the same base name, null if there is none. files: path, of one folder."""
    known = files.select(basename(F.col("path")).alias("_name"), F.col("path").alias("image_path")).dropDuplicates(["_name"])
    return rows.withColumn("_name", basename(F.col(column))).join(known, "_name", "left").drop("_name")


def dataset_settings(path: str) -> dict:
    """SC17: a dataset.yaml, which may hold YAML or JSON; the root must be a mapping."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        found = json.loads(text)
    except ValueError:
        import yaml

        found = yaml.safe_load(text)
    if not isinstance(found, dict):
        raise ValueError("a dataset must be a mapping")
    return found


def dataset_folder(settings: dict, file: str) -> str:
    """SC17: the dataset's own path; a relative one is below the folder of its file."""
    path = Path(str(settings.get("path") or "."))
    return str(path if path.is_absolute() else (Path(file).parent / path).resolve())


def eval_split(folder: str) -> str:
    """PF24: test, else val, whichever has images."""
    for split in ("test", "val"):
        if (Path(folder) / "images" / split).is_dir():
            return split
    raise FileNotFoundError(f"{folder} has neither images/test nor images/val")


def manifest_settings(raw: dict | None) -> dict:
    """SF20: settings of generated manifests with their defaults."""
    if not isinstance(raw or {}, dict):
        raise ValueError("manifest settings must be a mapping")
    found = dict(raw or {})
    guide = str(found.get("guide_type", "prompt")).strip().lower() or "prompt"
    if guide not in ("prompt", "image_guided"):
        raise ValueError("guide_type must be prompt or image_guided")
    name = str(found.get("trace_synth_name", "")).strip() or "synth_trace_manifest.jsonl"
    return found | {"guide_type": guide, "write_trace_artifacts": bool(found.get("write_trace_artifacts", False)), "trace_synth_name": name}


def needs_real_rows(backend: str, guide_type: str) -> bool:
    """SF20: only prompts alone, in the remote backend, need no real manifest."""
    return not (backend == "comfyui" and guide_type == "prompt")


