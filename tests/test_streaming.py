"""Molecules from a stream are those of the batch, whatever the order in which reads arrive."""

import datetime as dt
import random

from pyspark.sql import functions as F

from cellweave.operators import molecules
from cellweave.streaming import molecules as streaming

START = dt.datetime(2024, 1, 1)


def test_two_orders_of_arrival_give_the_batch_result(spark, tmp_path):
    rng = random.Random(2)
    hits = [(f"c{rng.randrange(5)}", "hg", f"g{rng.randrange(3)}", "".join(rng.choice("AC") for _ in range(4)), rng.random() < 0.5) for _ in range(300)]
    want = sorted(map(tuple, molecules.collapse_umis(molecules.count_umis(spark.createDataFrame(hits, "cell_barcode string, genome string, gene string, umi string, exonic boolean"))).select("cell_barcode", "genome", "gene", "umi", "counts", "exonic").collect()))
    streaming.use_state_store(spark)
    for turn in range(2):
        rng.shuffle(hits)
        here = tmp_path / str(turn)
        closing = [("end", "hg", "g", "AAAA", True)]
        for k, part in enumerate([hits[:120], hits[120:130], hits[130:], closing]):
            at = START + dt.timedelta(minutes=k if part is not closing else 60)
            spark.createDataFrame([(*h, at) for h in part], streaming.HIT_SCHEMA).coalesce(1).write.mode("append").parquet(str(here / "in"))
            query = streaming.write_molecules(streaming.stream_molecules(streaming.watch_hits(spark, str(here / "in"), 1)), str(here / "out"), str(here / "state"))
            query.awaitTermination(180)
            if part is not closing:
                assert not list((here / "out").glob("*.parquet")) or spark.read.parquet(str(here / "out")).count() == 0
        got = spark.read.parquet(str(here / "out")).where(F.col("cell_barcode") != "end")
        assert sorted(map(tuple, got.select("cell_barcode", "genome", "gene", "umi", "counts", "exonic").collect())) == want
