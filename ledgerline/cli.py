"""Command line: python -m ledgerline.cli ACTION --schema S [--target T] ..."""

from __future__ import annotations

import argparse
import contextlib
import sys
import time
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import SparkSession

from . import report
from .functions import dialect
from .operators import checks, transfer
from .plans import ddl
from .sources import catalog
from .sources.checkpoints import Checkpoint

ACTIONS = ("discover", "build", "build-views", "destroy", "migrate", "transfer", "validate")


class CommandError(Exception):
    pass


class Tee:
    """Writes to a stream and a file."""

    def __init__(self, stream, path: str) -> None:  # noqa: ANN001
        self.stream, self.file = stream, Path(path).open("a")

    def write(self, text: str) -> int:
        self.file.write(text)
        return self.stream.write(text)

    def flush(self) -> None:
        self.stream.flush()
        self.file.flush()

    def close(self) -> None:
        self.file.close()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerline", description="Move a schema and prove that the copy is faithful.")
    p.add_argument("action", choices=ACTIONS)
    p.add_argument("--schema", help="source schema")
    p.add_argument("--target", help="target schema")
    p.add_argument("--table", action="append", help="only this table; may be repeated")
    p.add_argument("--batch-size", type=int, default=10_000, help="rows that JDBC fetches or writes at once")
    p.add_argument("--batches", type=int, default=1, help="writes in which each table is copied; a checkpoint resumes after the last")
    p.add_argument("--workers", type=int, default=1, help="tables copied at once")
    p.add_argument("--checkpoint", help="file that remembers finished tables")
    p.add_argument("--where", help="condition on the rows of every table")
    p.add_argument("--limit", type=int, help="rows of each table at most")
    p.add_argument("--dry-run", action="store_true", help="say what would be done, for every action")
    p.add_argument("--format", choices=("text", "json"), default="text")
    p.add_argument("--output", help="write DDL to this file and don't run it")
    p.add_argument("--force", action="store_true", help="destroy without asking")
    p.add_argument("--continue-on-error", action="store_true")
    p.add_argument("--no-prompt", action="store_true")
    p.add_argument("--save-log", help="also write what is said to this file")
    p.add_argument("--sample-size", type=int, default=0, help="rows that validate compares by key")
    p.add_argument("--db", help="catalog of the target")
    return p


@contextlib.contextmanager
def logged(path: str | None) -> Iterator[None]:
    if not path:
        yield
        return
    tee = Tee(sys.stdout, path)
    try:
        with contextlib.redirect_stdout(tee):
            yield
    finally:
        tee.close()


class Command:
    def __init__(self, spark: SparkSession, options: argparse.Namespace) -> None:
        self.spark, self.o = spark, options

    def required(self, name: str) -> str:
        value = getattr(self.o, name)
        if not value:
            raise CommandError(f"--{name} is required for {self.o.action}")
        return value

    def run(self) -> bool:
        began = time.time()
        if self.o.db:
            self.spark.catalog.setCurrentCatalog(self.o.db)
        if self.o.action != "destroy":
            try:
                catalog.assert_schema_exists(self.spark, self.required("schema"))
            except catalog.SchemaNotFoundError as e:
                raise CommandError(str(e)) from e
        ok = getattr(self, self.o.action.replace("-", "_"))()
        print(f"{self.o.action}: {time.time() - began:.1f} s")
        return ok

    def discover(self) -> bool:
        found = catalog.discover(self.spark, self.o.schema, self.o.table)
        text = report.schema_json(found) if self.o.format == "json" else report.schema_text(found)
        if self.o.output:
            Path(self.o.output).write_text(text)
        else:
            print(text)
        return True

    def build(self, output: str | None = None) -> bool:
        found = catalog.discover(self.spark, self.o.schema, self.o.table, count=False)
        statements = ddl.schema_ddl(found, self.required("target"))
        if output := output or self.o.output:
            report.write_statements(statements, output)
            return True
        result = ddl.execute_ddl(self.spark, statements, not self.o.continue_on_error, self.o.dry_run)
        print(f"{result.ran} statements run, {len(result.failures)} failed")
        for statement, error in result.failures:
            print(f"  {statement}: {error}")
        if result.taken_back:
            print(f"  dropped again: {', '.join(result.taken_back)}")
        return result.ok

    def build_views(self, output: str | None = None) -> bool:
        target = self.required("target")
        views = catalog.views(self.spark, self.o.schema)
        wanted = {t.lower() for t in self.o.table or ()}
        found = [dialect.translate_view(v.name, v.ddl, target) for v in views if not wanted or v.name in wanted]
        stubs = [dialect.procedure_stub(p.name, p.ddl, target) for p in catalog.procedures(self.spark, self.o.schema)]
        stubs = [x for x in stubs if x and not wanted]
        if output := output or self.o.output:
            report.write_statements([v.ddl for v in found if v.ddl], output)
            if stubs:
                Path(f"{output}.procedures.sql").write_text("\n".join(stubs))
            return True
        if self.o.dry_run:
            print("\n".join([*(v.ddl or f"-- {v.name}: {v.reason}" for v in found), *stubs]))
            return True
        if stubs:
            print("\n".join(stubs))
        made, errors = dialect.build_views(self.spark, found, target)
        print(f"{len(made)} views made, {len(errors)} failed")
        for name, error in errors.items():
            print(f"  {name}: {error}")
        if errors:
            report.write_failed_views(found, errors, "failed_views.sql")
        return not errors

    def destroy(self) -> bool:
        target = self.required("target")
        statement = ddl.drop_schema_ddl(target)
        if self.o.dry_run:
            print(statement)
            return True
        if not self.o.force:
            if self.o.no_prompt:
                raise CommandError("destroy needs --force where there is no prompt")
            if input(f"type {target} to drop it with all its tables: ").strip() != target:
                print("nothing was dropped")
                return False
        return ddl.execute_ddl(self.spark, [statement]).ok

    def transfer(self) -> bool:
        target = self.required("target")
        options = {"where": self.o.where, "limit": self.o.limit}
        state = Checkpoint(self.o.checkpoint, self.o.schema, target, options) if self.o.checkpoint else None
        stats = transfer.transfer_schema(
            self.spark,
            self.o.schema,
            target,
            self.o.table,
            self.o.where,
            self.o.limit,
            self.o.workers,
            state,
            "append",
            self.o.dry_run,
            self.o.continue_on_error,
            lambda line: print(f"  {line}", flush=True),
            self.o.batches,
        )
        print(f"{sum(s.ok for s in stats)} of {len(stats)} tables, {sum(s.rows for s in stats)} rows")
        return all(s.ok for s in stats)

    def migrate(self) -> bool:
        output = self.o.output
        ok = self.build(f"{output}.tables.sql" if output else None)
        if not ok and not self.o.continue_on_error:
            return False
        if output:
            return self.build_views(f"{output}.views.sql")
        return self.transfer() and self.build_views() if ok else False

    def validate(self) -> bool:
        target = self.required("target")
        wanted = {t.lower() for t in self.o.table or ()}
        found = []
        for name in catalog.table_names(self.spark, self.o.schema):
            if wanted and name not in wanted:
                continue
            source = self.spark.table(ddl.quoted(self.o.schema, name))
            other = ddl.quoted(target.lower(), name)
            if not self.spark.catalog.tableExists(other):
                found.append(checks.TableReport(name).add("schema_check", False, "the target has no such table"))
                continue
            keys = catalog.primary_key(self.spark, self.o.schema, name)
            found.append(checks.reconcile(source, self.spark.table(other), name, keys, self.o.sample_size))
        if self.o.format == "json":
            rows = report.checks_frame(self.spark, found).toJSON().collect()
            print("[" + ",\n".join(rows) + "]")
        else:
            print(report.validation_text(found))
        return all(v.ok for v in found)


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    options = parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName("ledgerline").getOrCreate()
    with logged(options.save_log):
        try:
            return 0 if Command(spark, options).run() else 1
        except CommandError as e:
            print(f"error: {e}")
            return 2


if __name__ == "__main__":
    sys.exit(main())
