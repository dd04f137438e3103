"""Where results go: manifests by decision, label files, images, datasets, archives and services (SK1-SK17, OR12).

Files that belong to rows are written by the tasks that hold the rows, so that folders must be shared; writing twice gives the same.
"""

from __future__ import annotations

import json
import os
import shutil
import urllib.request
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path
from urllib.parse import urlencode

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..streaming import stream_folder
from . import write_manifest
from .transaction import post_once, write_decisions

MODES = ("copy", "hardlink", "symlink")
#: Left and right keypoints change places when an image is flipped: fixed values of the format.
FLIP_INDEX = [0, 2, 1, 4, 3, 6, 5, 8, 7, 10, 9, 12, 11, 14, 13, 16, 15]
KEYPOINT_SHAPE = [17, 3]


def write_document(path: str, found: dict) -> None:
    """SK2: one JSON document with two spaces; folders are made."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(found, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")


def write_by_decision(scores: DataFrame, folder: str, decisions: tuple[str, ...] = ("accept", "reject")) -> None:
    """SK3, SK4: the whole score table, and one manifest for each decision, empty ones too, in one pass, in place of what was there;
    another decision fails, and then what was there stays."""
    write_decisions(scores, folder, uuid.uuid4().hex, decisions, replace=True)


def place_file(source: str, target: str, mode: str = "copy") -> None:
    """SK5: target becomes a copy, hard link or symbolic link of source; what was there is replaced at once."""
    if mode not in MODES:
        raise ValueError(f"{mode} is none of {MODES}")
    Path(target).parent.mkdir(parents=True, exist_ok=True)
    fresh = f"{target}.{uuid.uuid4().hex}"
    if mode == "copy":
        shutil.copy2(source, fresh)
    elif mode == "hardlink":
        os.link(source, fresh)
    else:
        os.symlink(os.path.realpath(source), fresh)
    os.replace(fresh, target)


def place_image(source: str, target: str, mode: str = "copy", extension: str | None = None) -> None:
    """SK6: as place_file where the extension stays; else the image is written anew as JPEG, PNG or WEBP, which needs Pillow."""
    if extension is None or extension == Path(source).suffix.lower():
        return place_file(source, target, mode)
    kinds = {".jpg": "JPEG", ".png": "PNG", ".webp": "WEBP"}
    if extension not in kinds:
        raise ValueError(f"{extension} cannot be written")
    from PIL import Image

    Path(target).parent.mkdir(parents=True, exist_ok=True)
    fresh = f"{target}.{uuid.uuid4().hex}"
    with Image.open(source) as found:
        plain = found if extension != ".jpg" or found.mode in ("RGB", "L") else found.convert("RGB")
        plain.save(fresh, format=kinds[extension])
    os.replace(fresh, target)


def place_files(rows: DataFrame, mode: str = "copy", extension: str | None = None) -> None:
    """SK5, SK6 for every row (source, target), by the tasks."""
    if mode not in MODES:
        raise ValueError(f"{mode} is none of {MODES}")

    def place(part: Iterator[Row]) -> None:
        for r in part:
            place_image(r.source, r.target, mode, extension)

    rows.select("source", "target").foreachPartition(place)


def write_label_files(rows: DataFrame, folder: str, images: str | None = None, mode: str = "copy") -> None:
    """SK7: folder/labels/split/stem.txt with the label of every row (file_name, split, label), and its image, if a folder has them."""

    def write(part: Iterator[Row]) -> None:
        for r in part:
            name = Path(r.file_name)
            target = Path(folder) / "labels" / r.split / f"{name.stem}.txt"
            target.parent.mkdir(parents=True, exist_ok=True)
            fresh = target.with_name(f"{target.name}.{uuid.uuid4().hex}")
            fresh.write_text(r.label, encoding="utf-8")
            fresh.replace(target)
            if images is not None:
                place_file(str(Path(images) / name), str(Path(folder) / "images" / r.split / name.name), mode)

    rows.select("file_name", "split", "label").foreachPartition(write)


def dataset_document(folder: str, names: list[str], splits: dict[str, str], keypoints: bool = True) -> dict:
    """SK8, SK9: what a dataset.yaml says. splits: train, val and test with the folder of each; train is left out where it is not there."""
    there = {k: f"images/{v}" for k, v in splits.items() if k != "train" or (Path(folder) / "images" / v).is_dir()}
    shape = {"kpt_shape": KEYPOINT_SHAPE, "flip_idx": FLIP_INDEX} if keypoints else {}
    return {"path": str(Path(folder).resolve())} | there | shape | {"names": dict(enumerate(names))}


def write_dataset(folder: str, document: dict) -> str:
    """SK8, SK9: folder/dataset.yaml; JSON is YAML, too, and needs no other library."""
    path = f"{folder}/dataset.yaml"
    write_document(path, document)
    return path


def write_generated(rows: DataFrame, folder: str, settings: dict, report: dict) -> dict:
    """SK10: the manifest of generated rows (manifests.trace_rows), its trace copy if the settings ask for it, and the report."""
    told = report | {"synth_manifest": f"{folder}/synth_manifest.jsonl"}
    write_manifest(rows, told["synth_manifest"])
    if settings.get("write_trace_artifacts"):
        told["trace_synth_manifest"] = f"{folder}/{settings['trace_synth_name']}"
        write_manifest(rows, told["trace_synth_manifest"])
    write_document(f"{folder}/report.json", told)
    return told


def zip_folder(source: str, target: str) -> int:
    """SK11: the regular files of a folder, not of those below it, under their names alone; how many they are."""
    found = sorted(p for p in Path(source).iterdir() if p.is_file())
    Path(target).parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in found:
            z.write(p, p.name)
    return len(found)


def post_tasks(tasks: DataFrame, base_url: str, token: str, project: int, size: int = 500) -> None:
    """SK13: sends tasks (manifests.import_tasks) to a service in lists of at most so many, by the tasks of Spark; each list once, though
    tasks are tried again."""
    url = f"{base_url.rstrip('/')}/api/projects/{project}/import"
    lines = tasks.select(F.to_json(F.struct("data", "meta")).alias("line"))
    post_once(lines, stream_folder(tasks.sparkSession), uuid.uuid4().hex, url, {"Authorization": f"Token {token}"}, size).collect()


def save_outputs(jobs: DataFrame, base_url: str, folder: str) -> DataFrame:
    """SK14: every image of finished jobs, fetched and written by the tasks: a row for each with its file_name in the folder.

    jobs: seed, outputs (map of node to an array of filename, subfolder, type). A file that is written again is the same.
    """
    node = jobs.select("seed", F.explode("outputs").alias("node_id", "images"))
    image = node.select("seed", "node_id", F.posexplode("images").alias("turn", "i"))
    rows = image.select(
        F.format_string("seed_%s_n%s_%s_%s", F.col("seed").cast("string"), "node_id", F.col("turn").cast("string"), F.col("i.filename")).alias("file_name"),
        "seed",
        F.lit("comfyui").alias("source"),
        "node_id",
        F.col("i.filename").alias("comfy_filename"),
        F.coalesce(F.col("i.subfolder"), F.lit("")).alias("comfy_subfolder"),
        F.coalesce(F.col("i.type"), F.lit("output")).alias("comfy_type"),
    )

    def fetch(frames):
        Path(folder).mkdir(parents=True, exist_ok=True)
        for f in frames:
            for r in f.itertuples():
                query = urlencode({"filename": r.comfy_filename, "subfolder": r.comfy_subfolder, "type": r.comfy_type})
                with urllib.request.urlopen(f"{base_url.rstrip('/')}/view?{query}", timeout=60) as found:
                    content = found.read()
                fresh = Path(folder) / f"{r.file_name}.{uuid.uuid4().hex}"
                fresh.write_bytes(content)
                fresh.replace(Path(folder) / r.file_name)
            yield f

    return rows.mapInPandas(fetch, rows.schema)


def register_archive(base_url: str, name: str, archive: str, source_type: str = "manual", description: str | None = None, meta: dict | None = None) -> dict:
    """SK12: makes a collection and uploads an archive to it; what the service says about the samples."""
    base = base_url.rstrip("/")

    def post(path: str, body: bytes, kind: str, seconds: int) -> dict:
        request = urllib.request.Request(base + path, data=body, headers={"Content-Type": kind})
        with urllib.request.urlopen(request, timeout=seconds) as found:
            return json.loads(found.read())

    made = post("/collections/", json.dumps({"name": name, "description": description, "source_type": source_type, "meta": meta or {}}).encode(), "application/json", 30)
    mark = uuid.uuid4().hex
    fields = {"collection_run_id": str(made["id"]), "source_type": source_type, "meta": json.dumps(meta or {})}
    parts = [f'--{mark}\r\nContent-Disposition: form-data; name="{k}"\r\n\r\n{v}\r\n'.encode() for k, v in fields.items()]
    head = f'--{mark}\r\nContent-Disposition: form-data; name="archive"; filename="{Path(archive).name}"\r\nContent-Type: application/zip\r\n\r\n'.encode()
    body = b"".join([*parts, head, Path(archive).read_bytes(), f"\r\n--{mark}--\r\n".encode()])
    return post("/samples/from_archive", body, f"multipart/form-data; boundary={mark}", 600)


def writable(folder: str) -> bool:
    """SK15."""
    probe = Path(folder) / f".probe-{uuid.uuid4().hex}"
    try:
        Path(folder).mkdir(parents=True, exist_ok=True)
        probe.write_text("ok")
        probe.unlink()
    except OSError:
        return False
    return True


def output_folder(explicit: str | None, default: str, fallback: str) -> tuple[str, str]:
    """SK15: the folder that was asked for, else the default if it can be written, else the fallback; and which it is."""
    if explicit and explicit.strip():
        Path(explicit).mkdir(parents=True, exist_ok=True)
        return str(Path(explicit).resolve()), "cli"
    if writable(default):
        return default, "default"
    Path(fallback).mkdir(parents=True, exist_ok=True)
    return fallback, "fallback"


def run_folder(settings: dict, below: str = "") -> str:
    """SK16: artifacts_root/run_id, and a folder below it."""
    run = settings.get("run") or {}
    name = below.strip().strip("/")
    return "/".join(x for x in (str(run.get("artifacts_root", "artifacts/runs")), str(run.get("run_id", "m1_local_run")), name) if x)


def filter_input_path(settings: dict, argument: str | None = None) -> str:
    """SK17: the argument, else the configured path, else the place below the run's folder."""
    configured = str((settings.get("filter") or {}).get("siglip2_input_manifest_output") or "").strip()
    return argument or configured or run_folder(settings, "filter") + "/siglip2_input_manifest.jsonl"


def save_filter_inputs(rows: DataFrame, settings: dict, argument: str | None = None) -> str:
    """OR12, SK17: writes manifests.filter_inputs."""
    path = filter_input_path(settings, argument)
    write_manifest(rows, path)
    return path
