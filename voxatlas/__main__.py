"""Command line: ``python -m voxatlas project|config|run|combine``."""

from __future__ import annotations

import argparse
import json

from voxatlas.operators import ontology
from voxatlas.plans import config as configs
from voxatlas.plans.project import Project
from voxatlas.plans.stages import Pipeline, combine_folder
from voxatlas.session import session
from voxatlas.sources.images import read_image


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="voxatlas", description=__doc__)
    parser.add_argument("--master", help="the cluster; by default what spark-submit or Spark's settings say")
    commands = parser.add_subparsers(dest="command", required=True)
    change = commands.add_parser("config", help="create or change a project's parameters, and print them")
    change.add_argument("project")
    change.add_argument("--set", dest="changes", default="{}", help="parameters as JSON")
    make = commands.add_parser("project", help="a new project: its parameters and those of its registration")
    make.add_argument("project")
    run = commands.add_parser("run", help="an image to its region table")
    for name in ("image", "annotation", "ontology", "project"):
        run.add_argument(name)
    run.add_argument("--reference", help="the atlas' image, to which the specimen is registered")
    run.add_argument("--overwrite", action="store_true")
    run.add_argument("--no-tuning", action="store_true")
    run.add_argument("--visual", action="store_true")
    both = commands.add_parser("combine", help="the projects below a folder in one table")
    for name in ("root", "out"):
        both.add_argument(name)
    both.add_argument("--ontology", help="by default the one that the first project has kept")
    both.add_argument("--overwrite", action="store_true")
    given = parser.parse_args(arguments)

    spark = session(given.master)
    if given.command == "config":
        changes = configs.Config.from_json(given.changes)
        named = {k: getattr(changes, k) for k in json.loads(given.changes)}
        print(configs.update(spark, Project(given.project).config, **named).to_json())
    elif given.command == "run":
        annotation = read_image(spark, given.annotation).withColumnRenamed("v", "id")
        pipeline = Pipeline(spark, Project(given.project), overwrite=given.overwrite)
        reference = read_image(spark, given.reference) if given.reference else None
        pipeline.run(given.image, annotation, ontology.read(spark, given.ontology), reference=reference, tuning=not given.no_tuning, visual=given.visual)
    elif given.command == "project":
        Pipeline(spark, Project(given.project)).settings()
    else:
        combine_folder(spark, given.root, ontology.read(spark, given.ontology) if given.ontology else None, given.out, given.overwrite)


if __name__ == "__main__":
    main()
