"""FASTQ, paired: scans, checks and sinks."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessera.sources import paired


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no from 0, line) of a text file, or of a folder's files one after another by name, plain or gzip by suffix.

    Rows of a file's block are numbered without gaps by the scan, so that the blocks' sizes,
    a row each, are all that has to be known to number them through.
    """
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), F.input_file_block_start().alias("block"), F.monotonically_increasing_id().alias("row"), F.rtrim("value").alias("line"))
    counts = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    # a row for each input split: small, and bounded by the number of splits
    before = counts.select("file", "block", "first", (F.sum("n").over(W.orderBy("file", "block")) - F.col("n")).alias("before"))
    joined = lines.join(F.broadcast(before), ["file", "block"])
    return joined.select((F.col("before") + F.col("row") - F.col("first")).alias("line_no"), F.regexp_replace("line", "\r$", "").alias("line"))


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """(read_index, header, seq, sep, qual): four lines a record, in the file's order."""
    lines = numbered_lines(spark, path).withColumn("read_index", F.floor(F.col("line_no") / 4)).withColumn("k", F.col("line_no") % 4)
    pick = lambda k: F.max(F.when(F.col("k") == k, F.col("line")))
    return lines.groupBy("read_index").agg(pick(0).alias("header"), pick(1).alias("seq"), pick(2).alias("sep"), pick(3).alias("qual")).where("not (coalesce(header, '') = '' and seq is null)")


def read_id(header: Column) -> Column:
    """A header up to its first space, without @."""
    return F.regexp_replace(F.substring_index(header, " ", 1), "^@", "")


def pair(r1: DataFrame, r2: DataFrame, check: bool = True) -> DataFrame:
    """Mates by position, and by id: a mate that is missing or has another id ends the query."""
    a = r1.select("read_index", *[F.col(c).alias(f"r1_{c}") for c in ("header", "seq", "sep", "qual")])
    b = r2.select("read_index", *[F.col(c).alias(f"r2_{c}") for c in ("header", "seq", "sep", "qual")])
    return _named(a.join(b, "read_index", "full"), check)


def _named(both: DataFrame, check: bool) -> DataFrame:
    one = read_id(F.col("r1_header"))
    if check:
        fault = F.when(F.col("r1_header").isNull() | F.col("r2_header").isNull(), F.raise_error(F.lit("R1 and R2 have different numbers of records"))).when(one != read_id(F.col("r2_header")), F.raise_error(F.concat(F.lit("paired ids differ at record "), F.col("read_index").cast("string"))))
        one = F.coalesce(fault.cast("string"), one)
    return both.withColumn("read_id", one)


def read_pairs(spark: SparkSession, r1_path: str, r2_path: str, check: bool = True, **sizes: int) -> DataFrame:
    """(read_index, read_id, r1_*, r2_*) of two FASTQ files: in splits of both where pyarrow reaches them, else by a scan of each and a join."""
    both = paired.paired(spark, r1_path, r2_path, **sizes)
    if both is None:
        return pair(read_fastq(spark, r1_path), read_fastq(spark, r2_path), check)
    out = _named(both, check)
    out._stored_at = both._stored_at
    return out


#: What is wrong with a pair of read files, by rule; {line} is the record's first line.
RULES = {
    "ids": "the record at line {line} has another id in R1 than in R2",
    "at": "the header at line {line} doesn't begin with @",
    "forward": "the R1 record at line {line} has other letters than A, C, G, T and N",
    "reverse": "the R2 record at line {line} has other letters than A, C, G, T and N",
    "plus": "the record at line {line} has no + between bases and qualities",
    "length": "R1 and R2 end at different records, the shorter one before line {line}",
}


def violations(pairs: DataFrame) -> DataFrame:
    """(read_index, rule) of records that break a rule, each with its first. pairs: from pair(..., check=False)."""
    a, b = F.substring_index("r1_header", " ", 1), F.substring_index("r2_header", " ", 1)
    missing = F.col("r1_header").isNull() | F.col("r2_header").isNull()
    rule = (
        F.when(missing, "length").when(a != b, "ids").when(~a.startswith("@"), "at")
        .when(~F.col("r1_seq").rlike("^[ATCGN]*$"), "forward").when(~F.col("r2_seq").rlike("^[ATCGN]*$"), "reverse")
        .when((F.col("r1_sep") != "+") | (F.col("r2_sep") != "+"), "plus")
    )
    return pairs.select("read_index", rule.alias("rule")).where("rule is not null")


def check_paired(pairs: DataFrame) -> str:
    """"Valid", or the first fault's message."""
    # a fault within both files' length comes before the end of the shorter one
    first = violations(pairs).agg(F.min(F.struct((F.col("rule") == "length").alias("end"), "read_index", "rule")).alias("f")).first()["f"]
    if first is None:
        return "Valid"
    return "reads, " + RULES[first["rule"]].format(line=4 * first["read_index"] + 1)


def as_fastq(header: Column, seq: Column, qual: Column, sep: Column | None = None) -> Column:
    """A record's four lines."""
    return F.concat_ws("\n", header, seq, F.lit("+") if sep is None else sep, qual)


def write_fastq(df: DataFrame, path: str, header: Column, seq: Column, qual: Column, sep: Column | None = None, compression: str = "none") -> None:
    """Records in df's order, a file for each partition."""
    df.select(as_fastq(header, seq, qual, sep).alias("value")).write.option("compression", compression).text(path)


class FastqReader(DataSourceReader):
    """Byte ranges of plain FASTQ files; a range's records are those whose header begins in it."""

    def __init__(self, options: dict[str, str]):
        self.path, self.size = options["path"], int(options.get("rangeBytes", 64 << 20))

    def partitions(self) -> list[InputPartition]:
        import os

        total = os.path.getsize(self.path)
        return [InputPartition((i, min(total, i + self.size))) for i in range(0, total, self.size)] or [InputPartition((0, 0))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        begin, end = partition.value
        with open(self.path, "rb") as f:
            if begin:
                f.seek(begin - 1)
                f.readline()
                # a header is a line with @ two lines above one with +; a quality line may begin with @ as well
                while True:
                    at = f.tell()
                    lines = [f.readline() for _ in range(3)]
                    if not lines[0]:
                        return
                    if lines[0].startswith(b"@") and lines[2].startswith(b"+"):
                        f.seek(at)
                        break
                    f.seek(at)
                    f.readline()
            while f.tell() < end:
                at = f.tell()
                four = [f.readline().decode().rstrip("\r\n") for _ in range(4)]
                if not four[0]:
                    return
                yield (at, *four)


class FastqSource(DataSource):
    """spark.read.format("fastq").load(path) for splits of plain files: (offset, header, seq, sep, qual)."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return "offset long, header string, seq string, sep string, qual string"

    def reader(self, schema) -> DataSourceReader:
        return FastqReader(self.options)
