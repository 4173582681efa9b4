"""Commands over tables and folders that Spark can reach.

    curate FOLDER OUT                         structures to tables and model inputs
    search FASTA OUT --database uniref90      alignments of sequences, by external programs
    dataset stats|sample FOLDER               what a curated folder holds; entries drawn from it by weight
    store list|sync ROOT [TARGET]             objects below a folder; those that the target lacks are copied
    jobs submit|status|fetch FOLDER           tasks of jobs, kept as a table in the folder
    config show|init
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Config


def curate(spark: SparkSession, args: argparse.Namespace) -> None:
    from .plans.curate import curate, write

    write(curate(spark, args.source, Config.load(args.config)), args.target)


def search(spark: SparkSession, args: argparse.Namespace) -> None:
    """Writes ``id, found, output, error`` of each sequence; what isn't found is the query alone."""
    from .operators import search as S
    from .sources.alignments import read_fasta

    queries = read_fasta(spark, args.source, keep="last").select("id", "sequence").repartition("id")
    S.searched(queries, S.named_search(args.database, args.folder), args.timeout).write.mode("overwrite").parquet(args.target)
    print(json.dumps({r.error or "found": r["count"] for r in spark.read.parquet(args.target).groupBy("error").count().collect()}))


def dataset_stats(spark: SparkSession, folder: str) -> dict:
    """Structures by outcome, kept chains by kind, residues and interfaces of a curated folder."""
    table = lambda name: spark.read.parquet(f"{folder.rstrip('/')}/{name}")
    count = lambda df, column: {str(k): n for k, n in df.groupBy(column).count().collect()}
    outcomes = count(table("verdicts").select(F.coalesce("reason", F.lit("passed")).alias("outcome")), "outcome")
    return {"structures": outcomes, "chains": count(table("chains"), "kind"), "residues": table("chains").agg(F.coalesce(F.sum("n_residues"), F.lit(0))).first()[0], "interfaces": count(table("interfaces"), "type")}


def dataset_sample(spark: SparkSession, folder: str, n: int, seed: int) -> DataFrame:
    """Structures drawn with replacement; the weight of one grows with its kinds of chains."""
    from .operators import relational as R

    kinds = spark.read.parquet(f"{folder.rstrip('/')}/chains").groupBy("structure_id").agg(F.collect_set("kind").alias("kinds"))
    return R.drawn(kinds.withColumn("weight", R.chain_weight(F.col("kinds"))), "structure_id", "weight", n, seed)


def dataset(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.what == "stats":
        print(json.dumps(dataset_stats(spark, args.source), sort_keys=True))
    else:
        dataset_sample(spark, args.source, args.n, args.seed).write.mode("overwrite").parquet(args.target)


def store_keys(spark: SparkSession, root: str) -> DataFrame:
    """``key, path, length`` of the objects below a folder; their content is not read. Empty ones are passed over, as Spark's source does."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    return found.select(F.substring_index("path", f"{root.rstrip('/').rsplit('/', 1)[-1]}/", -1).alias("key"), "path", "length")


def store(spark: SparkSession, args: argparse.Namespace) -> None:
    from .sources import storage
    from .sources.tables import exists
    from .streaming.files import missing

    listing = store_keys(spark, args.root)
    if args.what == "list":
        for r in listing.orderBy("key").toLocalIterator():
            print(f"{r.length:>12} {r.key}")
        return
    there = store_keys(spark, args.target) if exists(spark, args.target) and store_keys(spark, args.target).limit(1).count() else listing.limit(0)
    lacking = missing(listing, there, args.overwrite, key="key")
    content = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(args.root).select("path", "content")
    storage.put_all(content.join(lacking.select("path", "key"), "path"), args.target)
    print(json.dumps({"copied": lacking.count()}))


TASKS = "job string, key string, task string, state string, tried int, priority int"


def jobs(spark: SparkSession, args: argparse.Namespace) -> None:
    """``submit`` makes a task of each object below ``--keys``; ``fetch`` assigns the next ones; the table is rewritten as a new version beside the old one."""
    from .sources.tables import exists
    from .streaming import tasks as T

    root = args.folder.rstrip("/")
    versions = sorted(int(p) for p in (r.key.split("/")[0].removeprefix("v") for r in store_keys(spark, root).select("key").collect()) if p.isdigit()) if exists(spark, root) else []
    now = spark.read.schema(TASKS).parquet(f"{root}/v{versions[-1]}") if versions else spark.createDataFrame([], TASKS)
    if args.what == "status":
        print(json.dumps([r.asDict() for r in T.job_status(now).orderBy("job").collect()]))
        return
    if args.what == "submit":
        new = T.submitted(store_keys(spark, args.keys).select(F.lit(args.job).alias("job"), "key"), "job", "key").withColumn("priority", F.lit(args.priority))
        out = now.filter(F.col("job") != args.job).unionByName(new.select(*now.columns))
    else:
        out = T.fetched(now, args.workers, [F.col("task")])
    out.select(*now.columns).write.mode("overwrite").parquet(f"{root}/v{versions[-1] + 1 if versions else 0}")


def config(args: argparse.Namespace) -> None:
    text = Config.load(args.config).to_json()
    if args.what == "show":
        print(text)
    else:
        with open(args.to, "w") as f:
            f.write(text)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="helixframe", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = out.add_subparsers(dest="command")

    def command(name: str, *positions: str, **options) -> argparse.ArgumentParser:
        one = commands.add_parser(name)
        for p in positions:
            one.add_argument(p)
        for o, default in options.items():
            one.add_argument(f"--{o}", default=default, **({"type": type(default)} if default is not None and not isinstance(default, bool) else {"action": "store_true"} if isinstance(default, bool) else {}))
        return one

    command("curate", "source", "target", config=None)
    command("search", "source", "target", database="uniref90", folder="databases", timeout=3600)
    some = command("dataset", config=None, target="sample", n=1000, seed=0)
    some.add_argument("what", choices=("stats", "sample"))
    some.add_argument("source")
    some = command("store", overwrite=False)
    some.add_argument("what", choices=("list", "sync"))
    some.add_argument("root")
    some.add_argument("target", nargs="?")
    some = command("jobs", job="job", keys=None, priority=0, workers=1)
    some.add_argument("what", choices=("submit", "status", "fetch"))
    some.add_argument("folder")
    some = command("config", config=None, to="helixframe.json")
    some.add_argument("what", choices=("show", "init"))
    return out


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "config":
        config(args)
        return 0
    run = {"curate": curate, "search": search, "dataset": dataset, "store": store, "jobs": jobs}.get(args.command)
    if run is None:
        parser().print_help()
        return 1
    run(SparkSession.builder.getOrCreate(), args)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
