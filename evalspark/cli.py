"""Command line: extract, classify, summarize, full."""

from __future__ import annotations

import argparse
import logging

from evalspark.adapters import EMBEDDING_MODEL, MAX_NEW_TOKENS, LibraryPdfDecoder, ModelEncoder, ModelSummarizer
from evalspark.operators.privacy import load_key
from evalspark.operators.stats import observed
from evalspark.operators.topics import Encoder, HashingEncoder
from evalspark.plans.pipeline import EvaluationPipeline
from evalspark.session import local_session
from evalspark.sources.archives import SimplePdfDecoder, TextDecoder
from evalspark.sources.tables import export, load, save_results, write_tables
from evalspark.sources.xlsx import read_workbook, write_workbook
from evalspark.operators.summarize import summarize_sheets


#: Names of commands and flags.
def parser() -> argparse.ArgumentParser:
    level = argparse.ArgumentParser(add_help=False)
    # suppressed, so that a level before the subcommand holds
    level.add_argument("--log-level", default=argparse.SUPPRESS)
    top = argparse.ArgumentParser(prog="evalspark", description=__doc__)
    top.add_argument("--log-level", default="INFO")
    sub = top.add_subparsers(dest="command", required=True)

    def encoder(p: argparse.ArgumentParser, flag: str) -> None:
        p.add_argument(flag, dest="model_name", nargs="?", const=EMBEDDING_MODEL, help="a sentence-transformers model; without it sentences are hashed")
        p.add_argument("--device")

    def generator(p: argparse.ArgumentParser) -> None:
        p.add_argument("--llm-model", help="a causal language model of transformers; without it summaries are extractive")
        p.add_argument("--max-new-tokens", type=int, default=MAX_NEW_TOKENS)
        p.add_argument("--no-4bit", action="store_true")

    def archives(p: argparse.ArgumentParser) -> None:
        p.add_argument("--zips", nargs="+", help="archives; they win over --input-folder")
        p.add_argument("--input-folder")
        p.add_argument("--output-dir", default="out")
        p.add_argument("--suffix", default="esr.pdf")
        p.add_argument("--anonymize", action="store_true")
        p.add_argument("--encrypt", action="store_true")
        p.add_argument("--aesgcm-key-env", default="AESGCM_KEY")

    extract = sub.add_parser("extract", parents=[level])
    archives(extract)
    extract.add_argument("--export", help="table to write: parquet, csv or xlsx by its suffix")
    extract.add_argument("--input-excel", help="earlier reports to unite with the new ones")

    classify = sub.add_parser("classify", parents=[level])
    classify.add_argument("--input", required=True)
    classify.add_argument("--rows", type=int)
    classify.add_argument("--columns", nargs="+", default=["C_Excellence", "C_Impact", "C_Implement"])
    classify.add_argument("--top-k", type=int, default=1)
    classify.add_argument("--output")
    classify.add_argument("--output-format", choices=["excel", "parquet", "both"], default="excel")
    classify.add_argument("--keep-embeddings", action="store_true")
    classify.add_argument("--no-flag-outliers", action="store_true")
    classify.add_argument("--iqr-multiplier", type=float, default=1.5)
    classify.add_argument("--ratio-threshold", type=float, default=0.98)
    classify.add_argument("--top-n-sentences", type=int, default=10)
    classify.add_argument("--dim", type=int, default=256, help="length of the hashing encoder's vectors")

    encoder(classify, "--model-name")

    summarize = sub.add_parser("summarize", parents=[level])
    generator(summarize)
    summarize.add_argument("--device")
    summarize.add_argument("--input", required=True)
    summarize.add_argument("--output", required=True)
    summarize.add_argument("--batch-size", type=int, default=32)
    summarize.add_argument("--text-column", default="Top_10_Sentences")
    summarize.add_argument("--sheet-name", default="all")

    full = sub.add_parser("full", parents=[level])
    archives(full)
    encoder(full, "--embedding-model")
    generator(full)
    full.add_argument("--classification-output")
    full.add_argument("--summary-output")
    full.add_argument("--top-k", type=int, default=1)
    full.add_argument("--top-n-sentences", type=int, default=10)
    full.add_argument("--summary-batch-size", type=int, default=4)
    full.add_argument("--skip-classify", action="store_true")
    full.add_argument("--skip-summarize", action="store_true")
    return top


def _sources(args: argparse.Namespace) -> list[str] | str:
    if not (args.zips or args.input_folder):
        raise SystemExit("give --zips or --input-folder")
    return args.zips or args.input_folder


def _decoder() -> TextDecoder:
    """A PDF library if one is installed, else the decoder of simple files."""
    try:
        return LibraryPdfDecoder()
    except ModuleNotFoundError:
        return SimplePdfDecoder()


def _encoder(args: argparse.Namespace) -> Encoder:
    return ModelEncoder(args.model_name, args.device) if getattr(args, "model_name", None) else HashingEncoder(getattr(args, "dim", 256))


def _summarizer(args: argparse.Namespace) -> ModelSummarizer | None:
    return ModelSummarizer(args.llm_model, args.device, args.max_new_tokens, not args.no_4bit) if getattr(args, "llm_model", None) else None


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=args.log_level.upper())
    log = logging.getLogger("evalspark")
    spark = local_session()
    pipeline = EvaluationPipeline(spark, _decoder(), _encoder(args), _summarizer(args))
    if args.command in ("extract", "full"):
        key = load_key(args.aesgcm_key_env) if args.encrypt else None
        earlier = load(spark, args.input_excel) if getattr(args, "input_excel", None) else None
        found = pipeline.extract(_sources(args), args.suffix, earlier, args.anonymize, key, args.encrypt)
        reports, seen = observed(found.reports, "reports")
        paths = write_tables({"extracted": reports, "files": found.files, "errors": found.errors}, args.output_dir, skip_empty=False)
        log.info("extracted %d reports to %s", seen.get["n"], paths)
        reports = spark.read.parquet(f"{args.output_dir}/extracted")
        if getattr(args, "export", None):
            log.info("exported to %s", export(reports, args.export))
        if args.command == "full" and not args.skip_classify:
            run = pipeline.run(reports=reports, summarize=not args.skip_summarize, top_n=args.top_n_sentences, classify_options={"top_k": args.top_k})
            log.info("classified to %s", save_results(run.classified, args.classification_output or f"{args.output_dir}/classified.xlsx", top_n=args.top_n_sentences))
            if run.summaries:
                write_workbook(run.summaries, args.summary_output or f"{args.output_dir}/classified_with_summary.xlsx", skip_empty=False)
    elif args.command == "classify":
        reports = load(spark, args.input)
        found = pipeline.classify(reports, args.columns, not args.no_flag_outliers, args.rows, args.iqr_multiplier, args.ratio_threshold, top_k=args.top_k, keep_embeddings=args.keep_embeddings)
        if found.isEmpty():
            log.warning("no negative sentence was found; nothing is written")
        else:
            log.info("classified to %s", save_results(found, args.output, args.output_format, top_n=args.top_n_sentences))
    else:
        sheets = read_workbook(spark, args.input)
        write_workbook(summarize_sheets(sheets, args.text_column, args.sheet_name, _summarizer(args), args.batch_size), args.output, skip_empty=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
