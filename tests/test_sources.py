"""Readers and writers on small files."""

import gzip

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strandloom.sources import readers, writers


def url(path):
    return f"file://{path}"


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">x one two\nACgt\nNN\n>y\n>x again\nAC\n")
    (tmp_path / "b.fa").write_text("")
    rows = readers.fasta(spark, url(tmp_path / "*.fa"))
    assert [(r.seq_id, r.description, r.seq) for r in rows.orderBy("path", "ord").collect()] == [("x", "one two", "ACGTNN"), ("y", "", ""), ("x", "again", "AC")]
    assert readers.sequence_count(rows).first().records == 3 and readers.total_length(rows).first().total_length == 8
    assert {r.seq_id: r.length for r in readers.sequence_lengths(rows).collect()} == {"x": 2, "y": 0}
    assert readers.first_sequence(rows).first().seq == "ACGTNN"
    one = rows.filter("description = 'one two'")
    assert readers.subsequence(one, "x", 1, 3).first().seq == "CG"
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.subsequence(one, "x", 1, 7).collect()
    long = spark.createDataFrame([("s", "A" * 165, "SUCCESS", "PASS"), ("t", "C", "SUCCESS", "HOLD"), ("u", "G", "SKIP", "HOLD")], "seq_id string, seq string, workflow_status string, result_disposition string")
    writers.write_fasta(long, url(tmp_path / "out"))
    assert {(r.seq_id, r.seq) for r in readers.fasta(spark, url(tmp_path / "out")).collect()} == {("s", "A" * 165), ("t", "C"), ("u", "G")}
    roles = writers.write_catalogue(long, url(tmp_path / "roles"))
    assert {r.role: r["count"] for r in roles.collect()} == {"accepted": 1, "review": 0, "hold": 1, "all_candidates": 2}
    assert readers.fasta(spark, url(tmp_path / "roles/role=all_candidates")).count() == 2


def test_fastq(spark, tmp_path):
    text = "".join(f"@r{i} x\n{'ACGT' * (i + 1)}\n+\n{'IIII' * (i + 1)}\n" for i in range(5))
    with gzip.open(tmp_path / "a.fq.gz", "wt") as f:
        f.write(text)
    with gzip.open(tmp_path / "none.fq.gz", "wt"):
        pass
    (tmp_path / "broken.fq.gz").write_bytes(b"\x1f\x8bnot a gzip stream")
    has = lambda name: readers.has_records(spark, url(tmp_path / name))
    assert has("a.fq.gz") and not has("none.fq.gz") and not has("absent.fq") and not has("broken.fq.gz")
    reads = readers.fastq(spark, url(tmp_path / "a.fq.gz"))
    assert [(r.record, r.name, len(r.seq)) for r in reads.orderBy("record").collect()] == [(i, f"r{i}", 4 * i + 4) for i in range(5)]
    stats = readers.fastq_stats(reads).first()
    assert (stats.reads, stats.bases, stats.mean_length) == (5, 60, 12.0)
    assert sorted(r.record for r in readers.every_kth(reads, 2).collect()) == [0, 2, 4]


def test_sample_sheet(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">x\nA\n")
    (tmp_path / "e.fa").write_text("")
    (tmp_path / "s.tsv").write_text("sample_id\tassembly\tr1\tr2\n# note\n\ngood\ta.fa\t/abs/r1\ta.fa\nbad/id\ta\tb\tc\ntwice\ta\tb\tc\ntwice\ta\tb\tc\nshort\ta\tb\nfull\ta.fa\t\tb\nempty\te.fa\ta.fa\ta.fa\nfine\ta.fa\ta.fa\ta.fa\n")
    sheet = readers.sample_sheet(spark, url(tmp_path / "s.tsv"))
    assert {r.sample_id: r.problem for r in sheet.collect()} == {"good": None, "bad/id": "unsafe id", "twice": "repeated id", "short": "not four columns", "full": "empty path", "empty": None, "fine": None}
    good = sheet.filter("sample_id = 'good'").first()
    assert good.assembly.endswith("/a.fa") and good.assembly.startswith("file:") and good.r1 == "/abs/r1"
    files = spark.read.format("binaryFile").load(url(tmp_path / "*.fa")).select("path", "length")
    told = {r.sample_id: r.problem for r in readers.missing_inputs(spark, sheet, files).collect()}
    assert told["fine"] is None and told["good"] == "missing or empty file: /abs/r1" and told["empty"].startswith("missing or empty file") and told["bad/id"] == "unsafe id"


def test_gfa(spark, tmp_path):
    def read(text):
        (tmp_path / "g.gfa").write_text(text)
        return readers.gfa(spark, url(tmp_path / "g.gfa"))

    segments, edges = read("H\tVN:Z:1.0\nS\t1\tacgt\tLN:i:4\tDP:f:2.5\nS\t2\tGT\n#x\nL\t1\t+\t2\t-\t2M\n")
    assert {r.seg_id: (r.seq, r.depth) for r in segments.collect()} == {"1": ("ACGT", 2.5), "2": ("GT", 0.0)}
    assert {tuple(r) for r in edges.collect()} == {("1", "+", "2", "-", 2), ("2", "+", "1", "-", 2)}
    assert readers.graph_problems(segments, edges).isEmpty()
    for bad in ("L\t1\t+\t2\t-\t2M1I", "L\t1\tx\t2\t-\t2M", "L\t1\t+"):
        with pytest.raises((PySparkException, Py4JJavaError)):
            read(f"S\t1\tAC\nS\t2\tAC\n{bad}\n")[1].collect()
    with pytest.raises((PySparkException, Py4JJavaError)):
        read("S\t1\t*\n")[0].collect()
    segments, edges = read("S\t1\tAC\nS\t1\tAC\nL\t1\t+\t9\t+\t0M\n")
    assert {tuple(r) for r in readers.graph_problems(segments, edges).collect()} == {("1", "repeated segment"), ("9", "undefined segment")}


def test_tables_and_texts(spark, tmp_path):
    (tmp_path / "h.tsv").write_text('c\t1\tA\t3\t.,"\t#I"\tIII\nc\tx\tA\t3\t.,\tI\tI\n')
    path = url(tmp_path / "h.tsv")
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.table(spark, path, readers.PILEUP).collect()
    assert readers.table(spark, path, readers.PILEUP, "skip").first().read_bases == '.,"'
    assert [r.malformed is None for r in readers.table(spark, path, readers.PILEUP, "keep").collect()] == [True, False]
    text = "10 + 0 in total (QC-passed reads + QC-failed reads)\n8 + 0 mapped (80.00% : N/A)\n6 + 0 properly paired (60%)\n"
    assert tuple(spark.range(1).select(readers.flagstat(text).alias("f")).first().f) == (10, 8, 80.0, 6)
    assert tuple(spark.range(1).select(readers.flagstat("nothing").alias("f")).first().f) == (None, None, 0.0, None)
    flags = spark.createDataFrame([(99,), (147,), (4,), (2064,)], "flag int").withColumn("k", F.lit(1))
    assert tuple(readers.flagstat_of(flags, ["k"]).first()) == (1, 4, 3, 75.0, 2)
    found = readers.json_paths(spark.createDataFrame([(1, '{"a": {"b": [1, null, "x"]}, "c": true, "d": {}}'), (2, "no json"), (3, None)], "k int, t string"), ["k"], "t")
    assert {tuple(r) for r in found.collect()} == {(1, "a.b[0]", "1"), (1, "a.b[1]", None), (1, "a.b[2]", "x"), (1, "c", "true"), (1, "d", "{}"), (2, "", "no json")}


def test_annotation_and_comparators(spark):
    rows = [(0, "lcl|NC_1_cds_9", "x [gene=b] [location=complement(<50..90)] [protein=P]"), (1, "lcl|NC_1_rrna_2", "[location=join(3..9,20..30)] [product=16S] [gbkey=rRNA]"), (2, "plain", "")]
    got = readers.annotated_entries(spark.createDataFrame(rows, "ord int, seq_id string, description string")).orderBy("place").collect()
    assert [(r.replicon, r.start, r.end, r.strand, r.gene, r["product"], r.partial) for r in got] == [("NC_1", 3, 30, "+", "", "16S", False), ("NC_1", 50, 90, "-", "b", "P", True), ("plain", 0, 0, "+", "", "", False)]
    report = [(0, "g", 27, 5, 100, 99, 98.0, "c", 9.0, "A,C"), (1, "g", 1, 5, 100, 9, 9.0, "c", 9.0, None)]
    r = readers.ariba_calls(spark.createDataFrame(report, "n int, " + readers.ARIBA), "n").first()
    assert (r.flag, r.ref_base_assembled, r.rows, r.multi_nt_rows) == (27, 99, 2, 1)
    kma = spark.createDataFrame([(" g ", 5, 1, 9, 99.0, 100.0, 99.0, 100.0, 4.0, 1.0, 0.0)], readers.KMA)
    assert readers.kma_calls(kma).first().template == "g"


def test_reports(spark, tmp_path):
    numbers = [0.0, 1.0, 123456.0, 1234567.0, 0.0001, 0.00001234567, -2.5, 0.1 + 0.2, 999999.5, 1e22]
    got = [r.x for r in spark.createDataFrame([(v,) for v in numbers], "v double").select(writers.general(F.col("v"), 6).alias("x")).collect()]
    assert got == ["%.6g" % v for v in numbers]
    rows = [("a", "SUCCESS", "HIGH", 99.95, 3.14159, 7, True), ("b", "SKIP", "", 0.0, None, None, None)]
    out = writers.batch_report(spark.createDataFrame(rows, "sample_id string, workflow_status string, qc_confidence string, best_identity_pct double, qc_length_zscore double, uncertain_base_count int, mixture_detected boolean"))
    assert len(out.columns) == 65
    a, b = out.orderBy("sample_id").collect()
    assert (a.status, a.result_disposition, a.qc_length_zscore, a.uncertain_base_count, a.mixture_detected, a.exact_known_allele, a.sequence_confidence, a.allele_length) == ("SUCCESS", "PASS", "3.14", "7", "true", "false", "HIGH", "0")
    assert (b.result_disposition, b.qc_length_zscore, b.best_identity_pct, b.mixture_detected, b.contigs_hit, b.remap_mean_depth) == ("HOLD", "", "", "", "0", "")
    paths = spark.createDataFrame([(1, "ACGT", 2.0, ["1+", "2-"])], "place int, seq string, depth double, path array<string>")
    writers.write_paths(paths, url(tmp_path / "p"))
    assert [r.value for r in spark.read.text(url(tmp_path / "p/fasta")).collect()] == [">graph_path_1 length=4 mean_graph_depth=2.00 nodes=1+,2-", "ACGT"]


def test_a_header_counts_as_one_only_before_the_first_row(spark, tmp_path):
    (tmp_path / "h.tsv").write_text("# note\nSample_ID\tassembly\tr1\tr2\nsample_id\tx\ty\tz\na\t/a\t/1\t/2\nsample_id\t/b\t/1\t/2\nb\t/a\t/1\t/2\n")
    rows = readers.sample_sheet(spark, url(tmp_path / "h.tsv")).collect()
    assert sorted((r.sample_id, r.problem) for r in rows) == [("a", None), ("b", None), ("sample_id", None)]
    (tmp_path / "only.tsv").write_text("sample_id\tassembly\tr1\tr2\n")
    assert readers.sample_sheet(spark, url(tmp_path / "only.tsv")).collect() == []


def test_an_incomplete_record_is_told(spark, tmp_path):
    (tmp_path / "cut.fq").write_text("@a\nACGT\n+\nIIII\n@b\nAC\n")
    rows = readers.fastq(spark, url(tmp_path / "cut.fq")).orderBy("record").collect()
    assert [(r.name, r.seq, r.quality, r.problem) for r in rows] == [("a", "ACGT", "IIII", None), ("b", "AC", None, "incomplete record")]
    assert readers.fastq_stats(readers.fastq(spark, url(tmp_path / "cut.fq"))).first().reads == 1
