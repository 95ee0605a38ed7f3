"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from strandframe.plans import REGISTRY
from strandframe.session import local_session

HEADLINE = (
    "entry_clean_and_measure P9_trim_by_composition A1_read_metrics A11_dedup_reads C2_prepare_reads A5_assembly_metrics "
    "A7_kmer_repeat_fraction W1_n50 W12_find_orfs J7_fix_mates A13_rmdup_pe A16_flagstat A18_depth W9_fragment_coverage "
    "J10_overlap F11_calc_md A21_site_counts A21_pileup A24_call_genotypes A26_apply_alternates W3_filter_variants "
    "A33_variant_qstats A27_reconcile_predictions W7_assign_locus_tags A10_annotation_metrics P29_annotate_UNIPROT "
    "C6_annotate S1_read_fastq S5_read_sam S13_genbank_features"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1).count()
    spent = {}
    for name in names:
        start = time.time()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        spent[name] = round(time.time() - start, 3)
    total = round(sum(spent.values()), 3)
    print(json.dumps({"metric": "headline queries, total wall time", "value": total, "unit": "sec", "queries": spent,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
