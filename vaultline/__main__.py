"""Job entry: python -m vaultline {generate,refresh,compact,forget} ... (or the same through spark-submit)."""

from __future__ import annotations

import argparse
import json

from vaultline.plans import refresh
from vaultline.session import build_session
from vaultline.sources import generator
from vaultline.sources.landing import CATALOG_KEY, landing_base


BATCH_BYTES = 256 * 1024**3


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="vaultline")
    commands = parser.add_subparsers(dest="command", required=True)

    generate = commands.add_parser("generate", help="fill the landing folders with synthetic records")
    generate.add_argument("landing", help="folder of the landing files, or with --catalog the root above it")
    generate.add_argument("--customers", type=int, default=generator.DEFAULT_CUSTOMERS)
    generate.add_argument("--transactions", type=int, default=generator.DEFAULT_TRANSACTIONS)

    run = commands.add_parser("refresh", help="bring all tables up to date with the landing folders")
    run.add_argument("landing", help="folder of the landing files, or with --catalog the root above it")
    run.add_argument("out")
    run.add_argument("--checkpoints", help="where stream progress is kept; without it, one batch run")
    run.add_argument(
        "--max-bytes-per-trigger", type=int, default=BATCH_BYTES, help="size of one batch of a backlog"
    )
    run.add_argument("--multi-line", action="store_true", help="a file holds one array over several lines")
    run.add_argument(
        "--found-fields", action="store_true", help="also keep fields beyond the known ones; reads new files twice"
    )
    run.add_argument("--database", help="catalog database whose gold tables are switched version by version")
    run.add_argument("--archive", help="folder to which landed files go once they are taken in (streams only)")

    for command in (generate, run):
        command.add_argument(
            "--catalog", nargs="?", const="", help="land below a catalog: the one named, or that of the session's catalog_name"
        )

    fold = commands.add_parser("compact", help="fold the change folders of the customers into their base, and the known keys")
    fold.add_argument("out")

    forget = commands.add_parser("forget", help="blank the identity of deleted customers in the stored tables")
    forget.add_argument("out")
    forget.add_argument("--database", help="catalog database of the gold tables, if they are switched there")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    chosen = arguments(argv)
    spark = build_session()
    landing = getattr(chosen, "landing", None)
    if getattr(chosen, "catalog", None) is not None:
        if chosen.catalog:
            spark.conf.set(CATALOG_KEY, chosen.catalog)
        landing = landing_base(spark, landing)
    if chosen.command == "generate":
        generator.write_landing(spark, landing, chosen.customers, chosen.transactions)
    elif chosen.command == "compact":
        print(refresh.compact_customers(spark, chosen.out))
        refresh.fold_keys(spark, chosen.out)
    elif chosen.command == "forget":
        print(json.dumps(refresh.forget_customers(spark, chosen.out, database=chosen.database), indent=2))
    if chosen.command != "refresh":
        return
    if chosen.checkpoints:
        counts = refresh.refresh_available(
            spark,
            landing,
            chosen.out,
            chosen.checkpoints,
            multi_line=chosen.multi_line,
            database=chosen.database,
            found_fields=chosen.found_fields,
            archive=chosen.archive,
            maxBytesPerTrigger=chosen.max_bytes_per_trigger,
        )
        print(json.dumps(counts, indent=2))
    else:
        extras = refresh.found_extras(spark, landing, chosen.multi_line) if chosen.found_fields else None
        counts = refresh.refresh_batch(spark, landing, chosen.out, extras, chosen.multi_line)
        print(json.dumps(counts, indent=2))


if __name__ == "__main__":
    main()
