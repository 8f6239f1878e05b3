"""Files as documents: discovery, routing by kind, pages, JSON artefacts, sinks."""

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexforge.functions import quality
from lexforge.functions import text as X
from lexforge.operators.work import OUTPUT_SUFFIXES, is_input, stem

# Extensions by kind, and the router's thresholds.
EXTENSIONS = {
    "pdf": [".pdf"], "image": [".jpg", ".jpeg", ".png", ".tiff", ".tif", ".bmp", ".gif"], "audio": [".mp3", ".wav", ".m4a", ".flac", ".ogg", ".wma"],
    "video": [".mp4", ".mkv", ".avi", ".mov", ".webm"], "docx": [".doc", ".docx"], "txt": [".txt", ".text"],
}
PAGE_WORDS, SCANNED_SHARE = 10, 0.1

PAGE = "struct<page_number:int,text:string,text_source:string,word_count:int,confidence:double,page_type:string,dark_ratio:double,line_count:int>"
DOCUMENT = T.StructType(
    [
        *(T.StructField(n, T.StringType()) for n in ("file_id", "file_path", "file_type", "extraction_method", "language", "text", "full_text")),
        T.StructField("total_pages", T.IntegerType()),
        T.StructField("pages", T.ArrayType(T.StructType([T.StructField("page_number", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("text_source", T.StringType()), T.StructField("word_count", T.IntegerType())]))),
        T.StructField("paragraphs", T.ArrayType(T.StringType())),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)


def kind_of(path: Column) -> Column:
    """The kind of a file by its extension in lower case; null for others."""
    ext = F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))
    out = F.lit(None).cast("string")
    for kind, names in EXTENSIONS.items():
        out = F.when(ext.isin(names), F.lit(kind)).otherwise(out)
    return out


def discovered(spark: SparkSession, folder: str) -> DataFrame:
    """path, length, kind of supported files below a folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", "length").distinct().withColumn("kind", kind_of(F.col("path"))).filter("kind IS NOT NULL")


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """path, text of text files, invalid bytes left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{txt,text,TXT,TEXT}").load(folder)
    fine = F.try_validate_utf8(F.col("content"))
    return files.select("path", F.coalesce(fine, _decoded(F.col("content"))).alias("text"))


@F.pandas_udf(T.StringType())
def _decoded(content: pd.Series) -> pd.Series:
    return content.map(lambda b: bytes(b).decode("utf-8", errors="ignore"))


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def paragraphs_of(data: bytes) -> list[str]:
    """Paragraphs of a word-processing file that aren't blank."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml"))
    found = ("".join(t.text or "" for t in p.iter(f"{_W}t")) for p in body.iter(f"{_W}p"))
    return [p for p in found if p.strip()]


@F.pandas_udf(T.ArrayType(T.StringType()))
def docx_paragraphs(content: pd.Series) -> pd.Series:
    def one(b):
        try:
            return paragraphs_of(bytes(b))
        except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
            return None

    return content.map(one)


def docx(spark: SparkSession, folder: str) -> DataFrame:
    """path, paragraphs, text; broken files have null paragraphs."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{docx,DOCX}").load(folder)
    return files.select("path", docx_paragraphs("content").alias("paragraphs")).withColumn("text", F.array_join("paragraphs", "\n\n"))


def pdf_pages(files: DataFrame) -> DataFrame:
    """path, page_number, text, has_images, word_count of PDF contents, by whichever reader is installed."""

    def run(frames: Iterator[pd.DataFrame]):
        for frame in frames:
            rows = [(p, *page) for p, data in zip(frame.path, frame.content, strict=True) for page in _read_pdf(bytes(data))]
            yield pd.DataFrame(rows, columns=["path", "page_number", "text", "has_images", "word_count"])

    return files.select("path", "content").mapInPandas(run, "path string, page_number int, text string, has_images boolean, word_count int")


def _read_pdf(data: bytes) -> list[tuple[int, str, bool, int]]:
    try:
        import fitz

        with fitz.open(stream=data, filetype="pdf") as doc:
            texts_ = [(p.get_text().strip(), bool(p.get_images())) for p in doc]
    except Exception:
        try:
            import pdfplumber
        except ModuleNotFoundError as missing:
            raise RuntimeError("reading PDF files needs PyMuPDF or pdfplumber") from missing
        with pdfplumber.open(io.BytesIO(data)) as doc:
            texts_ = [((p.extract_text() or "").strip(), bool(p.images)) for p in doc.pages]
    return [(i, t, images, len(t.split())) for i, (t, images) in enumerate(texts_, 1)]


def recognised(images: DataFrame, make=None) -> DataFrame:
    """Adds text and confidence to (…, content) by a recogniser that a worker holds."""
    schema = T.StructType([*[f for f in images.schema.fields if f.name != "content"], T.StructField("text", T.StringType()), T.StructField("confidence", T.DoubleType())])

    def run(frames):
        from lexforge.sources.backends import MockRecogniser

        reader = (make or MockRecogniser)()
        for frame in frames:
            got = reader.read(list(frame.content))
            yield frame.drop(columns="content").assign(text=[t for t, _ in got], confidence=[c for _, c in got])

    return images.mapInPandas(run, schema)


def transcribed(media: DataFrame, make) -> DataFrame:
    """Adds text, language, duration and segments (start, end, text) to (…, content) by a transcriber that a worker holds.

    make: gives an object whose read(bytes) returns these as a dict; there is none here.
    """
    segments = T.ArrayType(T.StructType([T.StructField("start", T.DoubleType()), T.StructField("end", T.DoubleType()), T.StructField("text", T.StringType())]))
    more = [T.StructField("text", T.StringType()), T.StructField("language", T.StringType()), T.StructField("duration", T.DoubleType()), T.StructField("segments", segments)]
    schema = T.StructType([*[f for f in media.schema.fields if f.name != "content"], *more])

    def run(frames):
        reader = make()
        for frame in frames:
            got = [reader.read(bytes(b)) for b in frame.content]
            yield frame.drop(columns="content").assign(**{f.name: [g.get(f.name) for g in got] for f in more})

    return media.mapInPandas(run, schema)


def extracted(spark: SparkSession, folder: str, recogniser=None, transcriber=None) -> DataFrame:
    """path, kind, text, extraction_method of the supported files below a folder, every kind by its own reader.

    PDF pages without words, and images, go to the recogniser; media files to the
    transcriber, and are left out where there is none.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "content", kind_of(F.col("path")).alias("kind"))
    of = lambda kind: files.filter(F.col("kind") == kind).select("path", "content")
    done = lambda rows, kind, method: rows.select("path", F.lit(kind).alias("kind"), "text", F.lit(method).alias("extraction_method"))
    plain = F.coalesce(F.try_validate_utf8(F.col("content")), _decoded(F.col("content")))
    parts = [
        done(of("txt").select("path", plain.alias("text")), "txt", "text"),
        done(of("docx").select("path", F.array_join(docx_paragraphs("content"), "\n\n").alias("text")), "docx", "docx_text"),
        done(recognised(of("image"), recogniser), "image", "ocr"),
    ]
    if of("pdf").limit(1).count():
        pages = pdf_pages(of("pdf")).groupBy("path").agg(F.array_sort(F.collect_list(F.struct("page_number", "text"))).alias("pages"))
        parts.append(done(pages.select("path", F.array_join(F.transform("pages", lambda p: p["text"]), "\n\n").alias("text")), "pdf", "pdf_text"))
    if transcriber is not None:
        parts += [done(transcribed(of(kind), transcriber), kind, "transcription") for kind in ("audio", "video")]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def page_range(pages: DataFrame, first: int, last: int) -> DataFrame:
    return pages.filter(F.col("page_number").between(first, last))


def word_count(text: Column) -> Column:
    return F.size(X.tokens(F.coalesce(text, F.lit(""))))


def scanned(pages: DataFrame) -> DataFrame:
    """file_id, is_scanned: fewer than a tenth of the pages have ten words."""
    share = F.avg((F.col("word_count") >= PAGE_WORDS).cast("double"))
    return pages.groupBy("file_id").agg((share < SCANNED_SHARE).alias("is_scanned"))


def routed(pages: DataFrame) -> DataFrame:
    """Adds text_source to pages (file_id, page_number, text, word_count, has_images, page_type): embedded, ocr or none.

    Where the embedded pages of a file together fail the quality gate, all of them go to recognition.
    """
    first = F.when(F.col("word_count") >= PAGE_WORDS, F.lit("embedded")).when(~F.col("has_images"), F.lit("none")).when(F.col("page_type").isin("text_like", "uncertain"), F.lit("ocr")).otherwise(F.lit("none"))
    rows = pages.withColumn("_first", first)
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_first") == "embedded", F.struct("page_number", "text")))), lambda p: p["text"]), "\n\n")
    verdict = rows.groupBy("file_id").agg(quality.gate(whole)["good"].alias("_good"))
    out = rows.join(verdict, "file_id").withColumn("text_source", F.when((F.col("_first") == "embedded") & ~F.col("_good"), F.lit("ocr")).otherwise(F.col("_first")))
    return out.drop("_first", "_good")


def method_of(pages: DataFrame) -> DataFrame:
    """file_id, extraction_method: hybrid, ocr_scanned or pdf_text, with the pages of each source."""
    n = lambda s: F.count_if(F.col("text_source") == s)
    rows = pages.groupBy("file_id").agg(F.count(F.lit(1)).alias("total_pages"), n("embedded").alias("pages_embedded"), n("ocr").alias("pages_ocr"), n("none").alias("pages_none"))
    method = F.when((F.col("pages_embedded") > 0) & (F.col("pages_ocr") > 0), F.lit("hybrid")).when(F.col("pages_ocr") > 0, F.lit("ocr_scanned")).otherwise(F.lit("pdf_text"))
    return rows.withColumn("extraction_method", method)


def json_documents(spark: SparkSession, folder: str, suffixes=tuple(OUTPUT_SUFFIXES)) -> DataFrame:
    """One JSON document a file, other artefacts left out; broken ones have _corrupt_record and no text."""
    rows = spark.read.schema(DOCUMENT).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").option("recursiveFileLookup", True).json(folder)
    path = F.col("_metadata.file_path")
    return rows.select("*", path.alias("_path")).filter(is_input(F.col("_path"), suffixes)).withColumn("file_id", F.coalesce("file_id", stem(F.col("_path"))))


def empty_files(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """Files of no bytes, which Spark's readers leave out; from the store's listing alone."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listing, found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True), []
    while listing.hasNext():
        f = listing.next()
        if f.getLen() == 0 and f.getPath().getName().endswith(suffix):
            found.append(f.getPath().toString())
    return found


def broken_summaries(spark: SparkSession, folder: str, suffix: str = "_summary.json") -> DataFrame:
    """path, problem of summary files that are empty or no JSON."""
    rows = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").text(folder).select(F.col("_metadata.file_path").alias("path"), "value")
    problem = F.when(X.strip(F.col("value")) == "", F.lit("empty")).when(F.try_parse_json("value").isNull(), F.lit("corrupted"))
    bare = spark.createDataFrame([(p, "empty") for p in empty_files(spark, folder, suffix)], "path string, problem string")
    return rows.select("path", problem.alias("problem")).filter("problem IS NOT NULL").unionByName(bare)


def source_texts(files: DataFrame, *candidates: DataFrame) -> DataFrame:
    """file_id, text of each file by the first of the candidates (file_id, text) that has one; of several texts of a candidate the least."""
    out = files.select("file_id")
    for i, c in enumerate(candidates):
        out = out.join(c.groupBy("file_id").agg(F.min(F.nullif("text", F.lit(""))).alias(f"_t{i}")), "file_id", "left")
    return out.select("file_id", F.coalesce(*(F.nullif(f"_t{i}", F.lit("")) for i in range(len(candidates)))).alias("text"))


def write(df: DataFrame, path: str, *parts: str) -> None:
    """Parquet, a run's partitions put in place of their former content; the committer makes it all or nothing."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (w.partitionBy(*parts) if parts else w).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, a row each, put in place by the committer: all or nothing."""
    df.write.mode("overwrite").json(path)


def delete(spark: SparkSession, paths: list[str]) -> int:
    """Deletes files; how many were there."""
    n = 0
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        n += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False))
    return n


def manifest_counts(rows: DataFrame) -> DataFrame:
    """One row for artefacts as ``json_documents`` reads them: whole ones, and those that are broken."""
    broken = F.col("_corrupt_record").isNotNull()
    return rows.agg(F.count_if(~broken).alias("whole"), F.count_if(broken).alias("corrupt"))


def append_manifest(lines: DataFrame, path: str) -> None:
    lines.write.mode("append").parquet(path)
