"""Transformations as parameter files: one text file each, lines of (name value ...).

Places are given as x, y, z in these files.  An affine file has the matrix by rows, then
the offset, and the centre it turns about; a B-spline file has all control points'
displacements along x, then y, then z, x running fastest.  A chain is a folder of files
that are numbered in the order in which they apply.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import SparkSession

from voxatlas.operators.transforms import Affine, BSplineField, Chain

#: Names of the files, of the kinds and of their parameters.
FILE = "TransformParameters.{}.txt"
AFFINE, BSPLINE = "AffineTransform", "BSplineTransform"
_LINE = re.compile(r'^\s*\(\s*(\w+)\s+(.*?)\s*\)\s*(?://.*)?$')
_VALUE = re.compile(r'"([^"]*)"|(\S+)')


def parse(text: str) -> dict[str, list[str]]:
    """The parameters of a file; other lines are comments."""
    found = (_LINE.match(line) for line in text.splitlines())
    return {m[1]: [a or b for a, b in _VALUE.findall(m[2])] for m in found if m}


def _numbers(given: dict[str, list[str]], name: str, default=None) -> np.ndarray:
    if name not in given and default is not None:
        return np.array(default, float)
    return np.array([float(v) for v in given[name]])


def transform(given: dict[str, list[str]]) -> Affine | BSplineField:
    """A transformation of places z, y, x from the parameters of a file."""
    kind = given["Transform"][0]
    values = _numbers(given, "TransformParameters")
    if kind == AFFINE:
        if len(values) != 12:
            raise ValueError(f"an affine transformation of three axes has 12 parameters, not {len(values)}")
        return Affine(values[:9].reshape(3, 3)[::-1, ::-1].copy(), values[9:][::-1].copy(), _numbers(given, "CenterOfRotationPoint", (0, 0, 0))[::-1].copy())
    if kind == BSPLINE:
        if int(given.get("BSplineTransformSplineOrder", ["3"])[0]) != 3:
            raise ValueError("splines of order 3 only")
        sizes = _numbers(given, "GridSize").astype(int)
        if len(values) != 3 * sizes.prod():
            raise ValueError(f"{len(values)} parameters for a grid of {sizes.tolist()}")
        spacing = _numbers(given, "GridSpacing")
        origin = _numbers(given, "GridOrigin", (0, 0, 0)) + _numbers(given, "GridIndex", (0, 0, 0)) * spacing
        grid = np.moveaxis(values.reshape(3, *sizes[::-1])[::-1], 0, 3)
        return BSplineField(np.ascontiguousarray(grid), origin[::-1].copy(), spacing[::-1].copy())
    raise ValueError(f"{kind} is neither {AFFINE} nor {BSPLINE}")


def text_of(step: Affine | BSplineField, before: str = "NoInitialTransform") -> str:
    """The file of a transformation; ``before`` names the one that applies first."""

    def line(name: str, *values) -> str:
        return f"({name} {' '.join(f'{chr(34)}{v}{chr(34)}' if isinstance(v, str) else repr(float(v)) if isinstance(v, float) else str(v) for v in values)})"

    def backwards(a: np.ndarray) -> list[float]:
        return [float(v) for v in a[::-1]]

    if isinstance(step, Affine):
        values = [*map(float, step.matrix[::-1, ::-1].ravel()), *backwards(step.offset)]
        own = [line("CenterOfRotationPoint", *backwards(step.centre))]
        kind = AFFINE
    else:
        values = [float(v) for v in np.moveaxis(step.grid, 3, 0)[::-1].ravel()]
        own = [line("GridSize", *(int(n) for n in step.grid.shape[2::-1])), line("GridIndex", 0, 0, 0), line("GridSpacing", *backwards(step.spacing)), line("GridOrigin", *backwards(step.origin)), line("BSplineTransformSplineOrder", 3)]
        kind = BSPLINE
    lines = [line("Transform", kind), line("NumberOfParameters", len(values)), line("TransformParameters", *values), line("InitialTransformParametersFileName", before), line("HowToCombineTransforms", "Compose"), line("FixedImageDimension", 3), line("MovingImageDimension", 3), *own]
    return "\n".join(lines) + "\n"


def read_transform(spark: SparkSession, path: str) -> Affine | BSplineField:
    return transform(parse(read_text(spark, path)))


def read_chain(spark: SparkSession, folder: str) -> Chain:
    """The numbered transformations of a folder, one after the other."""
    found = spark.read.text(f"{folder}/{FILE.format('[0-9]*')}", wholetext=True).selectExpr("value", "_metadata.file_name as name").collect()
    numbered = sorted((int(re.search(r"\.(\d+)\.txt$", r["name"])[1]), r["value"]) for r in found if re.search(r"\.(\d+)\.txt$", r["name"]))
    return Chain(tuple(transform(parse(text)) for _, text in numbered))


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One file of the driver's, in any store."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_chain(spark: SparkSession, chain: Chain, folder: str) -> None:
    """A chain as numbered files, each naming the one before it, and at the end a mark of success."""
    before = "NoInitialTransform"
    for k, step in enumerate(chain.steps):
        path = f"{folder}/{FILE.format(k)}"
        write_text(spark, path, text_of(step, before))
        before = path
    write_text(spark, f"{folder}/_SUCCESS", "")
