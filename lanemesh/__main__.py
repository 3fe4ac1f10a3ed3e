"""Command line: python -m lanemesh COMMAND ...

Tables are Parquet folders, as the plans read and write them.
"""

from __future__ import annotations

import argparse

from .plans import conflation, export, quality, references, targets
from .session import build_session
from .sources import readers

SPECS = {"npmrds": targets.NPMRDS, "ris": targets.RIS}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="lanemesh")
    commands = out.add_subparsers(dest="command", required=True)

    def command(name: str, *names: str, **optional: str) -> None:
        p = commands.add_parser(name)
        for n in names:
            p.add_argument(n)
        for n, text in optional.items():
            p.add_argument(f"--{n.replace('_', '-')}", help=text)

    command("load-target-map", "map", "source", "out", county="only this county code")
    command("load-references", "tiles", "out", area="a GeoJSON file that bounds them")
    command("conflate", "references", "matches", "out", priority="compat (default) or rank")
    command("release", "targets", "conflated", "out")
    return out


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"lanemesh-{args.command}")
    read = spark.read.parquet
    if args.command == "load-target-map":
        features, rejects = targets.load(spark, args.source, SPECS[args.map], args.county)
        targets.save(features, f"{args.out}/features")
        rejects.write.mode("overwrite").parquet(f"{args.out}/rejects")
    elif args.command == "load-references":
        kinds = (readers.tiles(spark, args.tiles, kind) for kind in ("geometry", "metadata", "reference"))
        references.reference_features(*kinds, area=readers.area(spark, args.area) if args.area else None).write.mode("overwrite").parquet(args.out)
    elif args.command == "conflate":
        segments, tags = conflation.conflated(read(args.references), read(args.matches), args.priority or "compat")
        segments.write.mode("overwrite").parquet(f"{args.out}/segments")
        tags.write.mode("overwrite").parquet(f"{args.out}/tags")
    else:
        segments, tags, features = read(f"{args.conflated}/segments"), read(f"{args.conflated}/tags"), read(args.targets)
        maps = [r[0] for r in targets.target_maps(tags).collect()]
        export.release(export.flat_map(segments, tags, maps), quality.lengths_by_feature(features, segments, tags), args.out)


if __name__ == "__main__":
    main()
