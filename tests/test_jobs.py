"""Each job from another folder, in a fresh process."""

import os
import subprocess
import sys

from conftest import ROOT

SF = "/root/testdata/sf0.001"


def run(folder, *args):
    env = {**os.environ, "PYTHONPATH": ROOT}
    done = subprocess.run([sys.executable, "-m", "tasteflow.jobs", "--master", "local[2]", *args], cwd=folder, env=env,
                          capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]


def test_every_job_runs_on_its_own(spark, tmp_dir):
    from tasteflow.sources import adapters, compose
    from tasteflow.streaming import statistics as streamed
    from tasteflow.streaming.sink import newest_lists

    ratings = adapters.ratings_view(spark, SF)
    inputs = {"movies": compose.movie_lines(adapters.movies_view(spark, SF)), "ratings": compose.rating_lines(ratings),
              "tags": compose.tag_lines(adapters.tags_view(spark, SF))}
    for name, lines in inputs.items():
        compose.write_lines(lines, f"{tmp_dir}/{name}")
    root = f"{tmp_dir}/tables"
    run(tmp_dir, "--ship", "load", "--root", root, *[x for n in inputs for x in (f"--{n}", f"{tmp_dir}/{n}")])
    run(tmp_dir, "statistics", "--root", root, "--genres", "old", "small")
    run(tmp_dir, "offline", "--root", root, "--rank", "4", "--iterations", "2", "--seed", "1", "--threshold", "0.5")
    run(tmp_dir, "tune", "--root", root, "--ranks", "2", "--regs", "0.1", "1.0", "--iterations", "1", "--seed", "1")
    tables = ("movie", "rating", "tag", "movie_index", "rate_more_movies", "genres_top_movies", "user_recs",
              "movie_similarity", "movie_recs", "als_grid", "als_best")
    assert all(spark.read.parquet(f"{root}/{t}").count() > 0 for t in tables)

    compose.write_lines(compose.rating_log_lines(ratings).limit(50), f"{tmp_dir}/logs")
    run(tmp_dir, "forward", "--source", f"{tmp_dir}/logs", "--sink", f"{tmp_dir}/forwarded", "--checkpoint",
        f"{tmp_dir}/ck1", "--once")
    forwarded = spark.read.parquet(f"{tmp_dir}/forwarded")
    assert forwarded.count() == 50
    compose.write_lines(forwarded, f"{tmp_dir}/events")
    run(tmp_dir, "recommend", "--root", root, "--source", f"{tmp_dir}/events", "--sink", f"{tmp_dir}/recs",
        "--checkpoint", f"{tmp_dir}/ck2", "--once", "--store-ratings", "--metrics", f"{tmp_dir}/times")
    assert newest_lists(spark, f"{tmp_dir}/recs").count() > 0
    assert spark.read.parquet(f"{tmp_dir}/times").where("rows > 0 and batch_ms > 0").count() > 0
    run(tmp_dir, "count", "--root", root, "--source", f"{tmp_dir}/events", "--sink", f"{tmp_dir}/kept", "--checkpoint",
        f"{tmp_dir}/ck3", "--once", "--seed")
    assert streamed.maintained(spark, f"{tmp_dir}/kept").agg({"n_rows": "sum"}).first()[0] == ratings.count() + 50
