"""Dataset configuration: JSON to sources, validated on the driver."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scan

TYPES = ("audio_dir", "pre_encoded", "s3", "wds")
#: Defaults of the object-store reader, in seconds and counts (fixed values).
STREAMING = {"connect_timeout_sec": 10, "idle_timeout_sec": 60, "stream_timeout_sec": 600, "max_attempts": 5}


def streaming_options(given: dict | None) -> dict[str, int]:
    out = {**STREAMING, **(given or {})}
    unknown = set(out) - set(STREAMING)
    if unknown:
        raise ValueError(f"unknown streaming options: {sorted(unknown)}")
    for k, v in out.items():
        if not isinstance(v, int) or isinstance(v, bool) or v <= 0:
            raise ValueError(f"{k} must be a positive whole number, not {v!r}")
    return out


def s3_conf(options: dict[str, int], profile: str | None = None) -> dict[str, str]:
    """The Hadoop settings that stand for those options: idle, connect and total timeouts and attempts."""
    conf = {
        "fs.s3a.connection.establish.timeout": f"{options['connect_timeout_sec']}s",
        "fs.s3a.connection.timeout": f"{options['idle_timeout_sec']}s",
        "fs.s3a.connection.request.timeout": f"{options['stream_timeout_sec']}s",
        "fs.s3a.attempts.maximum": str(options["max_attempts"]),
    }
    return conf | ({"fs.s3a.aws.credentials.provider": "software.amazon.awssdk.auth.credentials.ProfileCredentialsProvider"} if profile else {})


@dataclass
class Source:
    """One root of a dataset."""

    id: str
    path: str
    keywords: list[str] | None = None
    filelist_path: str | None = None
    weight: float = 1.0
    latent_extension: str = "npy"
    profile: str | None = None

    def frame(self, spark: SparkSession, kind: str) -> DataFrame:
        if kind == "pre_encoded":
            df = scan.latents(spark, self.path, self.latent_extension).select("path", "json_path")
        elif kind in ("s3", "wds"):
            df = scan.webdataset(spark, self.path).select(F.concat_ws("/", "url", "key").alias("path"), "members")
        elif self.filelist_path:
            df = scan.file_list(spark, self.path, self.filelist_path)
        else:
            df = scan.files(spark, self.path, keywords=self.keywords).select("path")
        return df.withColumns({"dataset_id": F.lit(self.id), "weight": F.lit(float(self.weight))})


@dataclass
class DatasetConfig:
    dataset_type: str
    datasets: list[Source]
    datasets_valid: list[Source] = field(default_factory=list)
    options: dict = field(default_factory=dict)
    options_valid: dict = field(default_factory=dict)
    streaming: dict[str, int] = field(default_factory=dict)

    @classmethod
    def parse(cls, text: str | dict) -> DatasetConfig:
        raw = json.loads(text) if isinstance(text, str) else dict(text)
        kind = raw.pop("dataset_type", None)
        if kind not in TYPES:
            raise ValueError(f"dataset_type must be one of {TYPES}, not {kind!r}")

        def sources(items: list[dict]) -> list[Source]:
            out = []
            for x in items:
                x = dict(x)
                path = x.pop("path", None) or x.pop("s3_path", None)
                if not path:
                    raise ValueError(f"dataset {x.get('id')!r} has no path")
                known = {k: v for k, v in x.items() if k in Source.__dataclass_fields__}
                out.append(Source(path=path, **known))
            return out

        first, valid = sources(raw.pop("datasets", [])), sources(raw.pop("datasets_valid", []))
        if not first:
            raise ValueError("no datasets are given")
        streaming = streaming_options(raw.pop("s3_streaming", None))
        low, high = raw.get("min_length_sec"), raw.get("max_length_sec")
        if low is not None and high is not None and low > high:
            raise ValueError("min_length_sec is over max_length_sec")
        plain = {k: v for k, v in raw.items() if not k.endswith("_valid")}
        return cls(kind, first, valid, plain, plain | {k[:-6]: v for k, v in raw.items() if k.endswith("_valid")}, streaming)

    def frame(self, spark: SparkSession, valid: bool = False) -> DataFrame:
        """UNION ALL of the roots with dataset_id and weight."""
        out = None
        for s in (self.datasets_valid or self.datasets) if valid else self.datasets:
            part = s.frame(spark, self.dataset_type)
            out = part if out is None else out.unionByName(part)
        return out


def check_request(prompts: list[str], durations: list[float], steps: int, cfg_scale: float, seed: int, batch_size: int, inpaint_starts: list | None = None, inpaint_ends: list | None = None) -> None:
    """A generation request's rules."""
    if steps <= 0 or batch_size <= 0:
        raise ValueError("steps and batch_size must be positive")
    if any(d <= 0 for d in durations):
        raise ValueError("durations must be positive")
    if (inpaint_starts is None) != (inpaint_ends is None):
        raise ValueError("inpaint starts and ends go together")
    if inpaint_starts is not None and (len(inpaint_starts) != len(inpaint_ends) or any(a >= b for a, b in zip(inpaint_starts, inpaint_ends, strict=False))):
        raise ValueError("inpaint intervals must pair up and have a length")
