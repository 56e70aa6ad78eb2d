"""python -m tessera STAGE... [--settings FILE] [name=value ...]: audit, prepare, train, infer, validate or all; exit 1 where a stage is not ok."""

import argparse
import json
import sys


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tessera", description=__doc__)
    parser.add_argument("words", nargs="+", metavar="STAGE or name=value")
    parser.add_argument("--settings", help="JSON file of settings; without it, the defaults")
    given = parser.parse_args(args)
    from pyspark.sql import SparkSession

    from tessera.plans.stages import STAGES, Run, run_stages
    from tessera.session import ship

    names = [w for w in given.words if "=" not in w]
    if not names or any(n not in STAGES and n != "all" for n in names):
        parser.error(f"stages are {', '.join(STAGES)} and all")
    run = Run.of(json.load(open(given.settings, encoding="utf-8")) if given.settings else {}, [w for w in given.words if "=" in w])
    spark = SparkSession.builder.appName("tessera").getOrCreate()
    ship(spark)
    reports = run_stages(spark, list(STAGES) if "all" in names else names, run)
    print(json.dumps(reports, indent=1, default=str))
    return int(not all(r["ok"] for r in reports))


if __name__ == "__main__":
    sys.exit(main())
