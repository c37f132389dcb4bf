"""Synthetic forms: values, layout and ground truth from a hash of the seed, so any partitioning gives the same forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quire.functions.boxes import flip_y
from quire.functions.text import seed_split
from quire.sources.forms import field, record

#: The fields of each form.
FORMS = {
    "supplier": ["supplier_name", "address", "city", "country", "tax_id", "contact_email", "payment_terms"],
    "invoice": ["invoice_number", "vendor_name", "issue_date", "due_date", "subtotal", "tax_rate", "total_amount"],
    "compliance": ["company_name", "reg_number", "compliance_date", "officer_name", "jurisdiction", "status"],
    "patient": ["patient_name", "date_of_birth", "mrn", "physician_name", "visit_date", "diagnosis", "insurance_id"],
}
#: Forms of each kind and their first seed.
BATCH = {"supplier": (50, 1000), "invoice": (50, 2000), "compliance": (30, 3000), "patient": (30, 4000)}

#: What kind of value each field takes.
KIND_OF = {
    "supplier_name": "company", "vendor_name": "company", "company_name": "company", "patient_name": "person", "officer_name": "person", "physician_name": "doctor",
    "address": "address", "city": "city", "country": "country", "contact_email": "email", "issue_date": "date", "due_date": "date", "compliance_date": "date", "date_of_birth": "date",
    "visit_date": "date", "subtotal": "amount", "total_amount": "amount", "tax_rate": "rate", "tax_id": "code", "reg_number": "code", "insurance_id": "code",
    "invoice_number": "reference", "mrn": "reference", "payment_terms": "payment_terms", "jurisdiction": "jurisdiction", "status": "status", "diagnosis": "diagnosis",
}
#: Words that values are made of, by kind or part.
WORDS = {
    "house": ("Northwind", "Bluestone", "Larkfield", "Oakmere", "Silverline"), "trade": ("Metals", "Foods", "Optics", "Paper"), "legal": ("Ltd.", "GmbH", "Inc.", "S.A."),
    "given": ("Ada", "Ben", "Cleo", "Dan", "Eva", "Finn"), "family": ("Moss", "Hale", "Byrd", "Roth", "Lind", "Ohm"), "street": ("Mill Lane", "Harbour Road", "Station Street"),
    "city": ("Lund", "Graz", "Turin", "Porto", "Cork", "Riga"), "country": ("GB", "DE", "FR", "ES"), "status": ("Approved", "Pending", "Rejected"), "payment_terms": ("Net 30", "Net 60", "Immediate"),
    "jurisdiction": ("Bavaria", "Ontario", "Delaware"), "diagnosis": ("Asthma", "Migraine", "Hypertension"),
}


def draw(seed: Column, name: Column, salt: str, n: int) -> Column:
    """A number from 0 below n."""
    return F.pmod(F.xxhash64(seed, name, F.lit(salt)), F.lit(n))


def value_of(kind: str, seed: Column, name: Column) -> Column:
    """A value of this kind: words, digits and days drawn by seed and name."""
    n = lambda part, below: draw(seed, name, part, below)
    word = lambda part: F.element_at(F.array(*map(F.lit, WORDS[part])), (n(part, len(WORDS[part])) + 1).cast("int"))
    if kind == "company":
        return F.concat_ws(" ", word("house"), F.when(n("has trade", 2) == 0, word("trade")), word("legal"))
    if kind in ("person", "doctor"):
        return F.concat_ws(" ", F.when(F.lit(kind == "doctor"), F.lit("Dr")), word("given"), word("family"))
    if kind == "email":
        return F.concat(F.lower(F.concat_ws(".", word("given"), word("family"))), F.lit("@"), F.lower(word("house")), F.lit(".example"))
    if kind == "address":
        return F.concat_ws(" ", (n("house number", 240) + 1).cast("string"), word("street"))
    if kind == "date":
        return F.date_format(F.date_add(F.lit("2015-01-01").cast("date"), n("day", 4000).cast("int")), "yyyy-MM-dd")
    if kind == "amount":
        return (n("cents", 5_000_000) / 100).cast("decimal(12,2)").cast("string")
    if kind == "rate":
        return F.concat((n("per cent", 25) + 1).cast("string"), F.lit(" %"))
    if kind == "code":
        return F.concat(F.char(n("first letter", 26) + 65), F.char(n("second letter", 26) + 65), F.lpad(n("digits", 10_000_000).cast("string"), 7, "0"))
    if kind == "reference":
        return F.concat_ws("/", (n("series", 9000) + 1000).cast("string"), F.lpad(n("number", 1_000_000).cast("string"), 6, "0"))
    return word(kind)


def fake_value(seed: Column, name: Column) -> Column:
    """A value of the kind that the field takes."""
    kind = F.create_map(*(F.lit(x) for kv in KIND_OF.items() for x in kv))[name]
    return F.coalesce(*(F.when(kind == k, value_of(k, seed, name)) for k in sorted(set(KIND_OF.values()))))


def layout(name_at: Column, total: Column) -> Column:
    """A field's box, origin bottom left: one line for each field, from the top down."""
    top = F.lit(0.82) - name_at * (F.lit(0.66) / total)
    return F.array(F.lit(0.36), top - 0.03, F.lit(0.9), top)


def forms(spark: SparkSession, batch: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """Records of all forms of a batch; unknown forms are an error."""
    batch = BATCH if batch is None else batch
    unknown = sorted(set(batch) - set(FORMS))
    if unknown:
        raise ValueError(f"unknown forms: {', '.join(unknown)}")
    plan = spark.createDataFrame([(k, n, base, FORMS[k]) for k, (n, base) in batch.items()], "form string, n int, base long, names array<string>")
    rows = plan.where("n > 0").select("form", "names", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"), "base").withColumn("seed", F.col("base") + F.col("i"))
    seed, size = F.col("seed"), F.size("names")
    fields = F.transform("names", lambda x, i: field(x, F.initcap(F.replace(x, F.lit("_"), F.lit(" "))), fake_value(seed, x), F.lit("answer"), flip_y(layout(i, size)), F.lit(0), "pdf"))
    doc_id = F.concat_ws("_", F.lit("synthetic"), "form", F.lpad(seed.cast("string"), 5, "0"))
    return record(
        rows, source=F.concat(F.lit("synthetic_"), F.col("form")), doc_id=doc_id, pdf_path=F.concat(doc_id, F.lit(".pdf")), page_count=F.lit(1), language=F.lit("en"), doc_class=F.col("form"),
        fields=fields, quality_tier=F.lit("clean_synthetic"), quality_score=F.lit(1.0), split=seed_split(seed),
    )


def form_files(docs: DataFrame) -> DataFrame:
    """The file of each record of forms(): doc_id, data (a one-page PDF with a filled widget for each field)."""
    import pyarrow as pa

    from quire.pdf.forms import form_file

    def run(batches):
        for b in batches:
            rows = b.to_pylist()
            data = [form_file(r["doc_class"].title(), [(f["field_id"], f["label"], f["value"], f["bbox_norm"]) for f in r["fields"]]) for r in rows]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return docs.select("doc_id", "doc_class", "fields").mapInArrow(run, "doc_id string, data binary")


class FormSource(DataSource):
    """spark.read.format("quire_forms").option("form", ...).option("count", ...).option("seed", ...): (form, seed, field_id, pos)."""

    @classmethod
    def name(cls) -> str:
        return "quire_forms"

    def schema(self) -> str:
        return "form string, seed bigint, field_id string, pos int"

    def reader(self, schema):
        return _FormReader(dict(self.options))


class _FormReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.form = options.get("form", "supplier")
        if self.form not in FORMS:
            raise ValueError(f"unknown form: {self.form}")
        self.count, self.seed = int(options.get("count", 1)), int(options.get("seed", 0))

    def partitions(self):
        return [InputPartition((a, min(self.count, a + 10_000))) for a in range(0, self.count, 10_000)]

    def read(self, partition):
        a, b = partition.value
        for i in range(a, b):
            for pos, name in enumerate(FORMS[self.form]):
                yield self.form, self.seed + i, name, pos
