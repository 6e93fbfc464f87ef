"""Runnable jobs: ``python -m tasteflow.jobs <job> ...`` or ``spark-submit -m``-style with the zipped package.

    load        three text inputs -> movie, rating, tag tables and the movie index
    statistics  rating counts, monthly counts, averages, top movies per genre
    offline     ALS model -> user lists, item similarity, item lists
    tune        grid search over rank x regularisation; writes the grid and its best row
    forward     application log lines -> rating payloads (runs until stopped)
    recommend   rating events -> suggestion lists (runs until stopped)
    count       rating events -> counts and averages kept up to date (runs until stopped)

Tables are stored under ``--root`` through any Spark data source (``--format``).
On a cluster set ``spark.checkpoint.dir`` to a shared folder; ``--ship`` sends this
package to the executors when it is not installed there.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tasteflow.operators import als
from tasteflow.plans import loader, offline, statistics, streaming_job
from tasteflow.schemas import MOVIE, RATING, SIMILARITY
from tasteflow.session import build_session, shared_dir, ship_package
from tasteflow.sources.tables import TableStore
from tasteflow.streaming import statistics as streamed

GRID_TABLE, BEST_TABLE = "als_grid", "als_best"


def _store(args: argparse.Namespace) -> TableStore:
    return TableStore(root=args.root, fmt=args.format)


def _loaded(spark: SparkSession, args: argparse.Namespace):
    store = _store(args)
    return (store, loader.read_clean(spark, store, loader.RATING_TABLE, RATING, keep=()),
            loader.read_clean(spark, store, loader.MOVIE_TABLE, MOVIE, keep=()))


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    loader.load_text_inputs(spark, args.movies, args.ratings, args.tags, _store(args), strict=args.strict)


def statistics_job(spark: SparkSession, args: argparse.Namespace) -> None:
    store, ratings, movies = _loaded(spark, args)
    statistics.run_statistics(movies, ratings, store, genres=args.genres, k=args.k, match=args.match)


def offline_job(spark: SparkSession, args: argparse.Namespace) -> None:
    store, ratings, movies = _loaded(spark, args)
    offline.run_offline(ratings, movies, store, rank=args.rank, max_iter=args.iterations, reg_param=args.reg,
                        threshold=args.threshold, seed=args.seed, k=args.k, list_k=args.list_k, num_blocks=args.blocks)


def tune(spark: SparkSession, args: argparse.Namespace) -> None:
    store, ratings, _ = _loaded(spark, args)
    grid, best = offline.run_tuning(ratings, args.ranks, args.regs, args.iterations, seed=args.seed, num_blocks=args.blocks)
    store.write(grid, GRID_TABLE)
    store.write(best, BEST_TABLE)


def _trigger(args: argparse.Namespace) -> dict:
    return {"availableNow": True} if args.once else {"processingTime": args.interval}


def forward(spark: SparkSession, args: argparse.Namespace) -> None:
    streaming_job.start_forwarder(spark, args.source, args.sink, args.checkpoint, trigger=_trigger(args)).awaitTermination()


def recommend(spark: SparkSession, args: argparse.Namespace) -> None:
    store, ratings, _ = _loaded(spark, args)
    similarity = store.read(spark, offline.MOVIE_SIMILARITY, SIMILARITY)
    query, job = streaming_job.start_recommender(
        spark, args.source, similarity, ratings, args.sink, args.checkpoint, trigger=_trigger(args),
        min_sim=args.min_sim, ratings_source=args.ratings_source,
        job_options={"store_ratings": args.store_ratings, "metrics_to": args.metrics})
    try:
        query.awaitTermination()
    finally:
        job.close()


def count(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.seed:
        streamed.seed_statistics(_loaded(spark, args)[1], args.sink)
    checkpoint = args.checkpoint or shared_dir(spark, "streams", "statistics")
    streamed.start_statistics(spark, args.source, args.sink, checkpoint, trigger=_trigger(args),
                              delay=args.delay).awaitTermination()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="python -m tasteflow.jobs", description=__doc__,
                                  formatter_class=argparse.RawDescriptionHelpFormatter)
    top.add_argument("--master", help="Spark master (default: the submitter's)")
    top.add_argument("--ship", action="store_true", help="send this package to the executors")
    jobs = top.add_subparsers(dest="job", required=True)

    def add(name: str, run, stored: bool = True) -> argparse.ArgumentParser:
        job = jobs.add_parser(name)
        job.set_defaults(run=run)
        if stored:
            job.add_argument("--root", required=True, help="folder of the stored tables")
            job.add_argument("--format", default="parquet")
        return job

    job = add("load", load)
    for name in ("movies", "ratings", "tags"):
        job.add_argument(f"--{name}", required=True, help="text input")
    job.add_argument("--strict", action="store_true", help="fail on the first bad line")

    job = add("statistics", statistics_job)
    job.add_argument("--genres", nargs="+")
    job.add_argument("--k", type=int, default=10)
    job.add_argument("--match", choices=["substring", "token"], default="substring")

    for name, run in (("offline", offline_job), ("tune", tune)):
        job = add(name, run)
        job.add_argument("--iterations", type=int, default=5)
        job.add_argument("--seed", type=int)
        job.add_argument("--blocks", type=int, default=als.DEFAULT_BLOCKS, help="factor blocks per side; raise with the data")
        if name == "offline":
            job.add_argument("--rank", type=int, default=50)
            job.add_argument("--reg", type=float, default=0.1)
            job.add_argument("--threshold", type=float, default=offline.SIM_THRESHOLD)
            job.add_argument("--k", type=int, default=offline.USER_K, help="items per user list")
            job.add_argument("--list-k", type=int, help="partners per item list (default: all)")
        else:
            job.add_argument("--ranks", type=int, nargs="+", default=[50, 60, 70, 80])
            job.add_argument("--regs", type=float, nargs="+", default=[0.1, 0.01, 1.0])

    for name, run, stored in (("forward", forward, False), ("recommend", recommend, True), ("count", count, True)):
        job = add(name, run, stored)
        job.add_argument("--source", required=True)
        job.add_argument("--sink", required=True)
        job.add_argument("--checkpoint")
        job.add_argument("--interval", default="2 seconds")
        job.add_argument("--once", action="store_true", help="process what is there, then stop")
        if name == "recommend":
            job.add_argument("--min-sim", type=float, default=streaming_job.MIN_SIM)
            job.add_argument("--store-ratings", action="store_true")
            job.add_argument("--ratings-source", help="folder where ratings that others store arrive, as lines")
            job.add_argument("--metrics", help="folder for the durations of the batches")
        if name == "count":
            job.add_argument("--seed", action="store_true", help="count the stored ratings first; before the first start only")
            job.add_argument("--delay", help="how late an event may be, such as '2 days'; also drops repeats (default: all count)")
    return top


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(args.master, app_name=f"tasteflow-{args.job}")
    try:
        if args.ship:
            ship_package(spark)
        args.run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
