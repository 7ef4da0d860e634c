"""The configured job from the command line: python -m quayside CONFIG [--dynamic | --publish] [--strict] [--drop-masked]"""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Sequence

from quayside.config import read_config
from quayside.plans.pipeline import ValidationError, publish_run, run_pipeline
from quayside.session import build_session
from quayside.sinks.versions import AuditError


def main(arguments: Sequence[str] | None = None) -> int:
    """Run the job; 0 if all staged data passed its validation, 1 if not. Data is never printed."""
    parser = argparse.ArgumentParser(prog="quayside", description="Stage the datasets of a configuration.")
    parser.add_argument("config", help="configuration document, on any file system that Spark reads")
    how = parser.add_mutually_exclusive_group()
    how.add_argument("--dynamic", action="store_true", help="replace only the partitions that landed")
    how.add_argument("--publish", action="store_true", help="write new versions, and publish those that pass their validation")
    parser.add_argument("--strict", action="store_true", help="fail on values that a cast would lose")
    parser.add_argument("--drop-masked", action="store_true", help="leave out the clear columns of masks")
    given = parser.parse_args(arguments)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    log = logging.getLogger("quayside")
    spark = build_session("quayside")
    config = read_config(spark, given.config)
    try:
        if given.publish:
            versions = publish_run(spark, config, strict=given.strict, drop_masked=given.drop_masked)
            log.info("%d datasets published", len(versions))
            return 0
        run = run_pipeline(
            spark,
            config,
            strict=given.strict,
            drop_masked=given.drop_masked,
            overwrite="dynamic" if given.dynamic else "static",
        )
    except (ValidationError, AuditError) as error:
        log.error("validation failed: %s", error)
        return 1
    log.info("%d datasets staged and validated", len(run.written))
    return 0


if __name__ == "__main__":
    sys.exit(main())
