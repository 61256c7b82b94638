"""Records of JSON exports, whatever is wrong around them: every good record, and one reject per bad span.

A file is JSON Lines if at least half of its lines that are not blank are an
object each, else it holds documents: one or several values over any lines.
Records are the objects of a list, the objects of the list ``records`` of an
object, or objects that have no such list.

* JSON Lines are split and judged line by line, in the JVM; a line that is not
  one object is cut into spans on its own.
* A file of documents is read as one ordered stream (a document cannot be
  split): a scanner follows strings and brackets and hands over each record as
  its last bracket closes, so a task holds one record, never a document.

What is left between records is a reject: text that is no JSON, values that are
no objects, a record that is cut off or broken inside, and the open bracket of a
list that the file does not close.  A record that is cut off ends where a line
begins with a bracket no further in.  Nothing is dropped: every character that
is neither white space nor a comma between values, nor around a list of records,
is in a record or in a reject.

Defined cases: blank lines and empty files give nothing; a byte order mark is
skipped; a record may span any lines; a string may not span lines (JSON does
not allow it), such a record is a reject.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORDS = "records"
#: Characters of a reject's text that are kept (its length tells the rest).
REJECT_CHARS = 2000
#: Stands behind a line when it is parsed, so that text after its first value is seen.
_END = "~end of line~"

#: Writer's options for the lines, which repeat their field names: a quarter less than at the codec's usual level.
_SMALL = {"parquet.compression.codec.zstd.level": "9"}

_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"?|[{}\[\],:]|[^\s"{}\[\],:]+')


class RecordScanner:
    """Cuts a stream of lines into records and rejects: ``feed`` each line, then ``end``.

    The open brackets are on a stack: ``list`` (a list that is a whole value), ``object`` (a whole value, once its
    list of records was seen), ``records`` (that list), ``beside`` (a bracket of another field of that object), and
    "{" or "[" (those of the open record)."""

    def __init__(self, key: str = RECORDS):
        self.key = key
        self.stack: list[str] = []
        self.parts: list[str] = []      # of the open span, from the lines before
        self.start = -1                 # where the span begins in this line; -1: none is open
        self.column = 0                 # where the open record began in its line
        self.indented = False           # whether a later line of it begins further in
        self.before = self.name = ""    # the token before; the last key
        self.found: list[tuple[bool, str]] = []
        self.line = ""

    def _span(self, at: int) -> None:
        if self.start < 0:
            self.start = at

    def _close(self, end: int, record: bool = False) -> None:
        """Hands over the open span, up to ``end``."""
        if self.start < 0:
            return
        text = ("".join(self.parts) + self.line[self.start:end]).strip()
        self.parts, self.start = [], -1
        if record:
            try:
                record = isinstance(json.loads(text), dict)
            except ValueError:
                record = False
        if text:
            self.found.append((record, text))

    def _top(self) -> str:
        return self.stack[-1] if self.stack else ""

    def _leave(self, *kinds: str) -> None:
        while self.stack and self.stack[-1] in kinds:
            self.stack.pop()

    def _opening(self, token: str, at: int) -> None:
        stack, top = self.stack, self._top()
        if (top in ("{", "[") and self.before != ":" and (top == "{" or self.indented)
                and at <= self.column and not self.line[:at].strip()):
            # Only a key may stand here (or what is indented): the open record is cut off, and this bracket, on a line
            # of its own and no further in, begins the next one.  (Elsewhere the record goes on and is no JSON.)
            self._close(at)
            self._leave("{", "[")
        elif top == "object" and self.before != ":" or top == "beside" and self.before not in (":", ",", "[", "{"):
            self._leave("beside", "object")                       # so is the object around the records
        top = self._top()
        if top in ("{", "["):
            if token == "[" and stack == ["{"] and self.name == f'"{self.key}"':
                stack[:] = ["object", "records"]                  # the fields before say nothing of its records
                self.parts, self.start = [], -1
            else:
                stack.append(token)
        elif top in ("object", "beside"):
            stack.append("records" if top == "object" and token == "[" and self.name == f'"{self.key}"' else "beside")
        else:
            self._close(at)                                       # words and values between records
            if token == "[" and not stack:
                stack.append("list")
            else:
                stack.append(token)
                self._span(at)
                self.column, self.indented = at, False

    def _closing(self, token: str, at: int) -> None:
        stack = self.stack
        mine = "{" if token == "}" else "["
        if self._top() in ("{", "["):
            own = [i for i, s in enumerate(stack) if s in ("{", "[")]
            inside = [i for i in own if stack[i] == mine]
            if inside:                                            # what is open inside it is cut off: no JSON then
                del stack[inside[-1]:]
                if inside[-1] == own[0]:
                    self._close(at + 1, record=True)
                return
            if not (token == "]" and own[0]):
                return                                            # closes nothing: the record is no JSON
            self._close(at)                                       # the list ends, its last record is cut off
            del stack[own[0]:]
        if self._top() == "beside":
            stack.pop()
        elif token == "]" and self._top() in ("list", "records"):
            self._close(at)
            stack.pop()
        elif token == "}" and self._top() in ("object", "records"):
            self._close(at)
            self._leave("records")
            self._leave("object")
        else:
            self._span(at)

    def feed(self, line: str) -> list[tuple[bool, str]]:
        self.line = line
        if self.start >= 0:
            self.start = 0
            self.indented |= line[:self.column + 1].isspace() and not line.isspace()
        for m in _TOKEN.finditer(line):
            token, at = m.group(), m.start()
            if token in "{[":
                self._opening(token, at)
            elif token in "}]":
                self._closing(token, at)
            elif token == ":":
                self.name = self.before
                if self._top() in ("", "list", "records"):
                    self._span(at)
            elif self._top() in ("", "list", "records"):
                if token == ",":
                    self._close(at)
                else:
                    self._span(at)
            self.before = token
        if self.start >= 0:
            self.parts.append(line[self.start:] + "\n")
            self.start = 0
        self.line = ""
        return self._taken()

    def end(self) -> list[tuple[bool, str]]:
        """The end of the file: what is open is cut off."""
        cut = self.stack and self.start < 0
        self._close(0)
        if cut:
            self.found.append((False, "{" if self.stack[0] in ("{", "object") else "["))
        self.stack, self.before, self.name = [], "", ""
        return self._taken()

    def _taken(self) -> list[tuple[bool, str]]:
        found, self.found = self.found, []
        return found


def _spans(found: list[tuple[bool, str]]) -> tuple[list, list, list]:
    return ([ok for ok, _ in found], [t if ok else t[:REJECT_CHARS] for ok, t in found], [len(t) for _, t in found])


_SPAN_SCHEMA = "file string, ok boolean, text string, size int"


def _batch(files: list[str], found: list[tuple[bool, str]]) -> pa.RecordBatch:
    ok, text, size = _spans(found)
    return pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(ok, pa.bool_()), pa.array(text, pa.string()),
                                       pa.array(size, pa.int32())], ["file", "ok", "text", "size"])


def _cut_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of lines (file, value), each on its own."""
    scanner = RecordScanner()
    for batch in batches:
        files, found = [], []
        for file, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            spans = scanner.feed(line) + scanner.end()
            files += [file] * len(spans)
            found += spans
        yield _batch(files, found)


def _cut_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of files whose lines (file, value) come in order, a file after the other."""
    scanner, current = RecordScanner(), None
    for batch in batches:
        files, found = [], []
        for file, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            spans = scanner.end() if file != current and current is not None else []
            files += [current] * len(spans)
            found += spans
            current = file
            spans = scanner.feed(line)
            files += [file] * len(spans)
            found += spans
        yield _batch(files, found)
    if current is not None:
        spans = scanner.end()
        yield _batch([current] * len(spans), spans)


def _is_object(line: Column) -> Column:
    """Whether a line is one object and nothing else, not holding a list of records: told in the JVM."""
    value = F.try_parse_json(F.concat(F.lit("["), line, F.lit(f',"{_END}"]')))
    alone = F.try_variant_get(value, "$[1]", "string").eqNullSafe(F.lit(_END))
    return (line.startswith("{") & alone & F.try_variant_get(value, f"$[0].{RECORDS}", "array<variant>").isNull())


def export_spans(spark: SparkSession, paths, shape: str | None = None) -> DataFrame:
    """(file, ok, text, size): every record (ok) and every reject of some exports.

    Lines are judged once and written to the shared folder with the verdict, and so are the spans that are cut; what
    reads the result parses nothing again.

    ``shape``: "lines" or "documents" for all files; None lets each file's own lines decide (a row per file reaches
    the driver, as in any listing)."""
    from roadlens.session import ship_package, written
    ship_package(spark)
    lines = (spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.btrim(F.regexp_replace("value", "^\\x{FEFF}", ""), F.lit(" \t\r\n")).alias("line")))
    if shape != "documents":
        lines = written(lines.where("line <> ''").withColumn("single", F.coalesce(_is_object(F.col("line")), F.lit(False))), "export-lines",
                        **_SMALL)
    if shape is None:
        by_file = (lines.groupBy("file")
                   .agg((2 * F.count_if("single") >= F.count(F.lit(1))).alias("lines")).collect())
        documents = sorted(r["file"] for r in by_file if not r["lines"])
        mixed = len(documents) < len(by_file)
    else:
        documents, mixed = None, shape == "lines"
    parts = []
    if mixed:
        own = lines if not documents else lines.where(~F.col("file").isin(documents))
        parts.append(own.where("single").select("file", F.lit(True).alias("ok"), F.col("line").alias("text"), F.length("line").alias("size")))
        parts.append(written(own.where("not single").select("file", "line").mapInArrow(_cut_lines, _SPAN_SCHEMA), "export-spans"))
    if documents or shape == "documents":
        own = spark.read.text(documents if documents else paths).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("id"), F.regexp_replace("value", "^\\x{FEFF}", "").alias("value"))
        n = min(len(documents), 2000) if documents else 200
        parts.append(written(own.repartition(n, "file").sortWithinPartitions("file", "start", "id").select("file", "value")
                             .mapInArrow(_cut_documents, _SPAN_SCHEMA), "export-spans"))
    if not parts:
        return spark.createDataFrame([], _SPAN_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def text_schema(records: DataFrame, text: str = "text") -> T.StructType:
    """The schema of JSON objects given as text, over all of them: nested as they are, every other value as text."""
    ddl = records.agg(F.schema_of_variant_agg(F.try_parse_json(text)).alias("s")).first()["s"]
    if not ddl or not ddl.startswith("OBJECT<") or ddl == "OBJECT<>":
        return T.StructType([])

    def as_text(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.StructType):
            return T.StructType([T.StructField(f.name, as_text(f.dataType)) for f in kind.fields]) if kind.fields else T.StringType()
        return T.ArrayType(as_text(kind.elementType)) if isinstance(kind, T.ArrayType) else T.StringType()

    # The type of an object is spelt OBJECT outside the quoted names.
    parts = re.split(r"(`(?:[^`]|``)*`)", ddl)
    return as_text(T._parse_datatype_string("".join(p if p.startswith("`") else p.replace("OBJECT<", "STRUCT<") for p in parts)))


def records_and_rejects(spark: SparkSession, paths, schema: T.StructType | None = None,
                        shape: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The records of some exports, and their rejects (file, text, size).

    The schema, the records and the rejects all read the spans as they were written."""
    spans = export_spans(spark, paths, shape)
    good = spans.where("ok")
    schema = schema or text_schema(good)
    if not schema.fields:
        records = spark.createDataFrame([], schema)
    else:
        records = good.select(F.from_json("text", schema).alias("r")).select("r.*")
    return records, spans.where("not ok").select("file", "text", "size")
