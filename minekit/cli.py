"""Command-line entry: one job per call.

Spec-driven jobs take the spec as JSON or base64 JSON:

    python -m minekit naive_bayes <base64 spec>
    spark-submit --py-files minekit.zip minekit/cli.py kmeans '{"datasource": ...}'

    jobs: naive_bayes, naive_bayes_fixed_layout, decision_tree,
          linear_regression, kmeans, association_rules, collaborative_filtering

Text and preview jobs take paths:

    python -m minekit score_text <model dir> <input text> <output dir>
    python -m minekit kmeans_text <input text> <output dir> <k> <iterations>
    python -m minekit preview <parquet path> <key column>

Nothing from a spec is printed (it may hold passwords).
"""

from __future__ import annotations

import sys

JOBS = ("naive_bayes", "naive_bayes_fixed_layout", "decision_tree", "linear_regression", "kmeans",
        "association_rules", "collaborative_filtering")


def main(argv: list[str] | None = None, spark=None) -> int:
    args = list(sys.argv[1:] if argv is None else argv)
    name, rest = (args[0], args[1:]) if args else ("", [])
    arity = {"score_text": 3, "kmeans_text": 4, "preview": 2}
    if not ((name in JOBS and len(rest) == 1) or arity.get(name) == len(rest)):
        print(__doc__, file=sys.stderr)
        return 2
    from minekit.plans import jobs
    from minekit.plans.spec import JobSpec
    from minekit.session import build_session

    spec = JobSpec.parse(rest[0]) if name in JOBS else None   # a bad spec fails before Spark starts
    own = spark is None
    spark = spark or build_session(app_name=f"minekit-{name}")
    try:
        if spec is not None:
            getattr(jobs, name)(spark, spec, write=True)
        elif name == "score_text":
            jobs.score_text_with_saved_model(spark, rest[0], rest[1], rest[2])
        elif name == "kmeans_text":
            out = jobs.kmeans_text(spark, rest[0], k=int(rest[2]), iterations=int(rest[3]))
            out.write.mode("errorifexists").text(rest[1])
        else:
            jobs.preview(spark, {"path": rest[0]}, rest[1]).show(truncate=False)
    finally:
        if own:
            spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
