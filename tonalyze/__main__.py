"""Command line: train, score, stream and report, as spark-submit jobs.

    python -m tonalyze train  (--sf-dir DIR | --csv FILE | --tables DOCS LABELS) --model OUT
    python -m tonalyze score  --model M --input PARQUET --text-col text [--out OUT] [--store S [--id-col C]]
    python -m tonalyze stream --model M --source DIR --sink DIR --checkpoint DIR [--every 5s]
    python -m tonalyze stream ... --available-now [--store S]    # and bring the batches into the store
    python -m tonalyze report NAME [--store S] [--stream-sink K] [--limit N] [--clase C] [--out OUT]
    python -m tonalyze migrate (--src LEGACY [--format json --rejected BAD] | --in-place) --dst STORE
    python -m tonalyze clear  --store S
    python -m tonalyze query  NAME --sf-dir DIR [--out OUT] [--show N]
    python -m tonalyze list

Output tables are written as parquet; ``--show`` prints rows instead.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None, spark=None) -> int:
    """Run one command; a given ``spark`` session is used and left running."""
    ap = argparse.ArgumentParser(prog="tonalyze")
    ap.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    sub = ap.add_subparsers(dest="cmd", required=True)

    t = sub.add_parser("train", help="fit on documents JOIN labels, or on a CSV, and save the model")
    corpus = t.add_mutually_exclusive_group(required=True)
    corpus.add_argument("--sf-dir", help="folder of the documents and labels tables")
    corpus.add_argument("--csv", help="CSV with a header")
    corpus.add_argument("--tables", nargs=2, metavar=("DOCUMENTS", "LABELS"),
                        help="catalog tables; bucketed alike (sources.bucketed) they join without a shuffle")
    t.add_argument("--text-col", default="texto", help="text column of the CSV")
    t.add_argument("--label-col", default="etiqueta", help="label column of the CSV")
    t.add_argument("--model", required=True)
    t.add_argument("--vocab-size", type=int, default=5000)
    t.add_argument("--stop-words", default="spanish")
    t.add_argument("--hashed", action="store_true")

    s = sub.add_parser("score", help="score a parquet table with a saved model")
    s.add_argument("--model", required=True)
    s.add_argument("--input", required=True)
    s.add_argument("--text-col", default="text")
    s.add_argument("--keep", default="", help="comma-separated columns to keep")
    s.add_argument("--out", default=None, help="write the scoring records here")
    s.add_argument("--store", default=None, help="append them to this predictions store")
    s.add_argument("--id-col", default=None, help="column that identifies a stored row (default: generated)")
    s.add_argument("--batch-id", default=None, help="a batch sent again under its id replaces itself")

    st = sub.add_parser("stream", help="score wire lines arriving in a folder")
    st.add_argument("--model", required=True)
    st.add_argument("--source", required=True)
    st.add_argument("--sink", required=True)
    st.add_argument("--store", default=None, help="with --available-now: bring new batches into this store")
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--every", default="1 second")
    st.add_argument("--max-files", type=int, default=None)
    st.add_argument("--available-now", action="store_true", help="process what is there, then stop")

    r = sub.add_parser("report", help="a report over stored predictions (store and/or stream sink)")
    r.add_argument("name", choices=["history", "stats", "summary", "share", "over-time", "overview", "json"])
    r.add_argument("--store", default=None)
    r.add_argument("--stream-sink", default=None)
    r.add_argument("--limit", type=int, default=50, help="history size; 0 = all")
    r.add_argument("--clase", default=None, help="history of one class only")
    r.add_argument("--out", default=None)
    r.add_argument("--show", type=int, default=20)

    mg = sub.add_parser("migrate", help="rewrite a legacy store to the unified schema (new path)")
    mg.add_argument("--src", help="folder of legacy rows")
    mg.add_argument("--format", default="parquet", help="of the legacy rows; json: documents, one a line")
    mg.add_argument("--rejected", help="where lines that are no documents go")
    mg.add_argument("--in-place", action="store_true", help="migrate the batches of the store --dst")
    mg.add_argument("--dst", required=True)

    cl = sub.add_parser("clear", help="delete every stored prediction; prints how many")
    cl.add_argument("--store", required=True)

    q = sub.add_parser("query", help="run a registered query")
    q.add_argument("name")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--out", default=None)
    q.add_argument("--show", type=int, default=20)

    sub.add_parser("list", help="list registered queries")
    args = ap.parse_args(argv)

    from tonalyze.plans import catalog
    if args.cmd == "list":
        print("\n".join(catalog.QUERIES))
        return 0

    from pyspark.ml import PipelineModel
    from pyspark.sql import functions as F

    from tonalyze.operators import classifier as clf
    from tonalyze.operators import reports, store
    from tonalyze.session import build_session
    from tonalyze.sources import csv_corpus
    from tonalyze.sources import tables as T
    from tonalyze.streaming import scoring as stream

    own = spark is None
    if own:
        spark = build_session(args.master)
    if args.cmd == "train":
        params = clf.ClassifierParams(vocab_size=args.vocab_size,
                                      stop_words_language=args.stop_words, hashed=args.hashed)
        if args.csv:
            rows = csv_corpus.read_labelled_csv(spark, args.csv, args.text_col, args.label_col)
        elif args.tables:
            rows = T.corpus_of(*map(spark.table, args.tables))
        else:
            rows = T.labelled_corpus(spark, args.sf_dir)
        model = clf.train(rows, params)
        model.write().overwrite().save(args.model)
        print(f"model saved to {args.model}; classes {clf.label_names(model)}")
    elif args.cmd == "score":
        model = PipelineModel.load(args.model)
        df = spark.read.parquet(args.input).withColumn("texto", F.col(args.text_col))
        keep = [c for c in args.keep.split(",") if c]
        if not args.out and not args.store:
            ap.error("score needs --out, --store or both")
        if args.out:
            clf.scoring_record(clf.score(model, df, keep=keep)).write.mode("errorifexists").parquet(args.out)
        if args.store:
            kept = ["texto", *([args.id_col] if args.id_col and args.id_col != "texto" else [])]
            store.append_predictions(store.enrich_for_store(clf.score(model, df, keep=kept), args.id_col),
                                     args.store, batch_id=args.batch_id)
    elif args.cmd == "stream":
        model = PipelineModel.load(args.model)
        if args.available_now:
            lines = stream.text_source(spark, args.source, args.max_files)
            scored = stream.score_lines(model, lines)
            stream.run_available(scored, args.sink, args.checkpoint)
            if args.store:
                print(f"stored: {stream.append_to_store(spark, args.sink, args.store)}")
        elif args.store:
            ap.error("--store needs --available-now")
        else:
            stream.start_scoring(model, spark, args.source, args.sink, args.checkpoint,
                                 every=args.every, max_files_per_trigger=args.max_files).awaitTermination()
    elif args.cmd == "report":
        preds = store.read_predictions(spark, args.store, args.stream_sink)
        limit = args.limit or None
        if args.name == "history":
            df = (reports.latest_by_class(preds, args.clase, limit) if args.clase
                  else reports.latest_predictions(preds, limit))
        elif args.name == "stats":
            df = reports.class_stats(preds)
        elif args.name == "summary":
            df = reports.class_summary(reports.class_stats(preds, ordered=False))
        elif args.name == "share":
            df = reports.class_share(reports.class_stats(preds, ordered=False))
        elif args.name == "over-time":
            df = reports.class_over_time(preds)
        elif args.name == "overview":
            df = reports.overview(preds)
        else:
            df = reports.predictions_json(preds, limit)
        if args.out:
            df.write.mode("errorifexists").parquet(args.out)
        else:
            df.show(args.show, truncate=80)
    elif args.cmd == "migrate":
        if args.in_place:
            matched, modified = store.migrate_in_place(spark, args.dst)
        elif not args.src or (args.format == "json" and not args.rejected):
            ap.error("migrate needs --src (and --rejected for JSON documents) or --in-place")
        else:
            matched, modified = store.migrate_store(spark, args.src, args.dst, args.format, rejected=args.rejected)
        print(f"matched_count: {matched}")
        print(f"modified_count: {modified}")
    elif args.cmd == "clear":
        print(f"deleted: {store.clear_predictions(spark, args.store)}")
    elif args.cmd == "query":
        df = catalog.QUERIES[args.name](spark, args.sf_dir)
        if args.out:
            df.write.mode("errorifexists").parquet(args.out)
        else:
            df.show(args.show, truncate=80)
    if own:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
