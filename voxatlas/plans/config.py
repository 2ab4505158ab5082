"""Parameters of the staged pipeline, with their defaults and checks."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, fields, replace

from pyspark.sql import SparkSession

Slice = tuple[int | None, int | None, int | None]
WHOLE: Slice = (None, None, None)


@dataclass(frozen=True)
class Config:
    """The defaults."""

    atlas_dir: str | None = None
    ref_version: str = "average_template_25"
    annot_version: str = "ccf_2016_25"
    map_version: str = "ABA_annotations"
    chunk: tuple[int, int, int] = (400, 400, 400)
    ref_orient: tuple[int, int, int] = (1, 2, 3)
    ref_trim: tuple[Slice, Slice, Slice] = (WHOLE, WHOLE, WHOLE)
    rough: tuple[int, int, int] = (3, 6, 6)
    fine: tuple[float, float, float] = (1.0, 0.6, 0.6)
    trim: tuple[Slice, Slice, Slice] = (WHOLE, WHOLE, WHOLE)
    lower_bound: tuple[int, int] = (100, 0)
    upper_bound: tuple[int, int] = (5000, 5000)
    mask_gauss_blur: float = 1
    mask_threshold: float = 300
    tuning_trim: tuple[Slice, Slice, Slice] = ((0, 100, None), (0, 2000, None), (0, 2000, None))
    overlap_depth: int = 50
    tophat_sigma: int = 10
    dog_sigma1: float = 1
    dog_sigma2: float = 4
    large_gauss_sigma: float = 101
    threshold: float = 60
    min_threshold_size: int = 100
    max_threshold_size: int = 10000
    maxima_sigma: int = 10
    min_wshed_size: int = 1
    max_wshed_size: int = 1000
    combine_cellc_trim: tuple[Slice, Slice, Slice] = ((0, 10, None), WHOLE, WHOLE)
    heatmap_raw_radius: int = 5
    heatmap_trfm_radius: int = 3

    def __post_init__(self):
        if sorted(map(abs, self.ref_orient)) != [1, 2, 3]:
            raise ValueError("ref_orient is a permutation of 1, 2, 3 with signs")
        if not self.lower_bound[0] < self.upper_bound[0] or self.lower_bound[1] > self.lower_bound[0] or self.upper_bound[1] < self.upper_bound[0]:
            raise ValueError("the intensity bounds must be in order")

    def updated(self, **changes) -> "Config":
        """A checked copy with some parameters changed."""
        return replace(self, **changes)

    def to_json(self) -> str:
        return json.dumps(asdict(self), indent=4)

    @classmethod
    def from_json(cls, text: str) -> "Config":
        """Unknown parameters are ignored, lists become tuples."""

        def tuples(value):
            return tuple(map(tuples, value)) if isinstance(value, list) else value

        known = {f.name for f in fields(cls)}
        return cls(**{k: tuples(v) for k, v in json.loads(text).items() if k in known})


def read(spark: SparkSession, path: str) -> Config:
    """The parameters at a path that Spark can read."""
    return Config.from_json("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


def found(spark: SparkSession, path: str) -> bool:
    """Whether there are parameters at a path."""
    from pyspark.errors import AnalysisException

    try:
        read(spark, path)
    except AnalysisException:
        return False
    return True


def write(spark: SparkSession, config: Config, path: str) -> None:
    spark.createDataFrame([(config.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def update(spark: SparkSession, path: str, **changes) -> Config:
    """Create the parameters if missing, change them, and write them back if they differ."""
    from pyspark.errors import AnalysisException

    try:
        old = read(spark, path)
    except AnalysisException:
        old = None
    new = (old or Config()).updated(**changes)
    if new != old:
        write(spark, new, path)
    return new
