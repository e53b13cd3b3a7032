"""Clinical letters: text sections, prompts, rule-based and pluggable extraction, findings."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions import text as X
from cohortloom.functions.deid import clean_mrn
from cohortloom.operators.ordering import top_per_key
from cohortloom.operators.predicates import row_digest

if TYPE_CHECKING:
    import pandas as pd

# Section ids of the XML letters.
THERAPY_SECTION = "M5_Therapie"
DIAGNOSIS_SECTION = "M5_Diagnosen"

LETTER_COLUMNS = [
    "source_type",
    "patient_id",
    "account_id",
    "document_date",
    "letter_status",
    "template_name",
    "diagnosis_text",
    "therapie_text",
    "histologie_text",
    "molekularpatho_text",
    "immunhisto_text",
    "initial_risk_stratification_text",
]

_GENE = "struct<gene:string,mutated:boolean,variant_detail:string,date:string,evidence_text:string>"
_KARYOTYPE = "struct<raw_text:string,classification:string,date:string,evidence_text:string>"
_ELN = "struct<risk_category:string,raw_text:string,date:string,evidence_text:string>"
RESULT_DDL = f"genes array<{_GENE}>, karyotypes array<{_KARYOTYPE}>, eln_risk array<{_ELN}>, notes string"


def _letter(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    return df.select(
        *[values.get(c, F.lit(None)).cast("string").alias(c) for c in LETTER_COLUMNS]
    )


def _once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with more columns, each worked out once a row.

    Conditions on a plain projection are pushed below it with their expressions written out, and so
    work a costly text out again; they stop at the generator of a list of one.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def letters_from_documents(
    docs: DataFrame, therapy_id: str = THERAPY_SECTION, diagnosis_id: str = DIAGNOSIS_SECTION
) -> DataFrame:
    """Letters with a therapy section out of XML documents; ``skipped_documents`` counts the others."""
    sections = _once(
        docs,
        {
            "_therapy": X.extract_section("xmldocument", therapy_id),
            "_diagnosis": X.extract_section("xmldocument", diagnosis_id),
        },
    ).where(F.col("_therapy").isNotNull())

    def optional(c: str) -> Column:
        return F.nullif(F.col(c).cast("string"), F.lit(""))

    return _letter(
        sections,
        {
            "source_type": F.lit("xml"),
            "patient_id": F.col("patid"),
            "account_id": F.col("patientaccountid"),
            "document_date": optional("lastsaveddatetime"),
            "letter_status": optional("letterstatus"),
            "template_name": optional("templatename"),
            "diagnosis_text": X.html_to_text("_diagnosis"),
            "therapie_text": X.html_to_text("_therapy"),
        },
    )


def skipped_documents(docs: DataFrame, therapy_id: str = THERAPY_SECTION) -> DataFrame:
    """How many documents there are, and how many give no letter for want of a therapy section."""
    missing = X.extract_section("xmldocument", therapy_id).isNull()
    return docs.agg(F.count(F.lit(1)).alias("documents"), F.count_if(missing).alias("skipped"))


ENTRY_TEXTS = {
    "histologie_text": "Histologie/Zytologie:",
    "molekularpatho_text": "Molekularpatho/zytologie:",
    "immunhisto_text": "Immunhisto/zytologie:",
    "initial_risk_stratification_text": "Initiale TNM-Klassif./Risikostrat.:",
}


def letters_from_entries(
    entries: DataFrame, texts: dict[str, str] = ENTRY_TEXTS, patient: str = "PatID", date: str = "Dokumentdatum"
) -> DataFrame:
    """Letters out of a tabular export; rows without patient or without any text are left out."""
    cells = {name: X.strip_tags(F.col(f"`{c}`")) for name, c in texts.items() if c in entries.columns}
    letters = _letter(
        entries,
        {
            "source_type": F.lit("excel"),
            "patient_id": clean_mrn(X.strip_tags(F.col(f"`{patient}`"))),
            "document_date": X.strip_tags(F.col(f"`{date}`")),
            **cells,
        },
    )
    return letters.where(F.col("patient_id").isNotNull() & F.coalesce(*[F.col(c) for c in cells]).isNotNull())


def letter_key(letters: DataFrame, name: str = "letter_key") -> DataFrame:
    """``patient_account_date``; a letter without date gets a digest of its content instead."""
    date = F.coalesce(F.nullif(X.safe_name("document_date"), F.lit("")), row_digest(letters))
    return letters.withColumn(
        name, F.concat_ws("_", X.safe_name("patient_id"), X.safe_name("account_id"), date)
    )


def key_collisions(letters: DataFrame, name: str = "letter_key") -> DataFrame:
    return letters.groupBy(name).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


# Section titles in order.
PROMPT_SECTIONS = [
    ("Document date", "document_date"),
    ("Diagnosis summary", "diagnosis_text"),
    ("Therapy/follow-up timeline", "therapie_text"),
    ("Histology/cytology", "histologie_text"),
    ("Molecular pathology/cytogenetics", "molekularpatho_text"),
    ("Immunohistochemistry/immunophenotyping", "immunhisto_text"),
    ("Initial risk stratification", "initial_risk_stratification_text"),
]


def letter_prompt(letters: DataFrame, name: str = "prompt") -> DataFrame:
    """Labelled sections in fixed order, absent ones omitted."""
    parts = [
        F.when(F.col(c) != "", F.concat(F.lit(f"## {title}\n"), F.col(c)))
        for title, c in PROMPT_SECTIONS
        if c in letters.columns
    ]
    return letters.withColumn(name, F.concat_ws("\n\n", *parts))


# Phrases of results, words that turn a result round, and genes usually tested in leukaemia.
MUTATED_PHRASES = ["nachgewiesen", "nachweisbar", "positiv", "Nachweis einer", "mutiert"]
WILDTYPE_PHRASES = ["Wildtyp", "nicht nachweisbar", "negativ", "unauffällig", "kein Nachweis", "unmutiert"]
NEGATORS = ["nicht", "kein", "keine", "keinen", "keiner", "ohne", "weder"]
GENES = [
    "FLT3", "NPM1", "TP53", "IDH1", "IDH2", "CEBPA", "RUNX1", "ASXL1", "DNMT3A", "KIT", "NRAS",
    "KRAS", "TET2", "WT1", "BCR-ABL", "PML-RARA", "KMT2A", "GATA2", "JAK2", "SF3B1", "SRSF2",
]

_BEFORE, _AFTER = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_WORD = r"[\p{L}\p{N}]+"


def _one_of(phrases: Sequence[str]) -> str:
    """Pattern of whole phrases, the longest first."""
    return "(?:" + "|".join(r"\Q" + p.strip() + r"\E" for p in sorted(phrases, key=len, reverse=True)) + ")"


def _mention_pattern(genes: Sequence[str], mutated: Sequence[str], wildtype: Sequence[str], negators: Sequence[str]) -> str:
    """Groups: a negative result, a positive one, a gene, the border of a clause.

    Results are whole words in any case and with any German ending. A positive one is negative
    behind a negator with at most two words in small letters between, and before "nein" or "nicht".
    """
    ending = "(?:e[rsnm]?)?" + _AFTER
    positive = _one_of(mutated) + ending
    negative = [_one_of(wildtype) + ending]
    if negators:
        negative.insert(0, f"{_one_of(negators)}\\s+(?:[\\p{{Ll}}-]+\\s+){{0,2}}{positive}")
        negative.insert(1, f"{positive}\\s*:?\\s*(?:nein|nicht){_AFTER}")
    return f"{_BEFORE}(?:(?iu:({'|'.join(negative)})|({positive}))|({_one_of(genes)}){_AFTER})|([,;])"


def gene_results(sentence: Column, genes: Sequence[str], mutated: Sequence[str], wildtype: Sequence[str], negators: Sequence[str]) -> Column:
    """Genes of a sentence with their results, as array of struct(gene, mutated), each pair once.

    Every mention of a gene is bound to the nearest result of its clause, counted in words, of two
    equally near ones to the one behind it. A clause without a result, as in a list of genes, takes
    that of the next clause with one, or else of the last before it.
    """
    # Mentions become records of their groups between marks: text, record, text, record, ..., text.
    pattern = _mention_pattern(genes, mutated, wildtype, negators)
    parts = F.split(F.regexp_replace(sentence, pattern, "\u0001$1\u0002$2\u0002$3\u0002$4\u0001"), "\u0001", -1)
    kinds = ["negative", "positive", "gene", "border"]
    state = "struct<at:int,clause:int,found:array<struct<kind:string,name:string,at:int,clause:int>>>"

    def step(acc: Column, part: Column) -> Column:
        fields = F.split(part, "\u0002", -1)
        record = F.size(fields) == len(kinds)
        kind = F.coalesce(*[F.when(F.get(fields, F.lit(i)) != "", F.lit(k)) for i, k in enumerate(kinds)])
        border = kind == "border"
        words = F.when(record, F.when(border, 0).otherwise(1)).otherwise(F.size(F.regexp_extract_all(part, F.lit(_WORD), F.lit(0))))
        mention = F.struct(kind.alias("kind"), F.get(fields, F.lit(2)).alias("name"), acc["at"].alias("at"), acc["clause"].alias("clause"))
        return F.struct(
            (acc["at"] + words).cast("int").alias("at"),
            (acc["clause"] + F.when(record & border, 1).otherwise(0)).cast("int").alias("clause"),
            F.when(record & ~border, F.concat(acc["found"], F.array(mention))).otherwise(acc["found"]).alias("found"),
        ).cast(state)

    first = F.struct(F.lit(0).alias("at"), F.lit(0).alias("clause"), F.array().cast("array<struct<kind:string,name:string,at:int,clause:int>>").alias("found"))

    def bound(found: Column) -> Column:
        results = F.filter(found, lambda m: m["kind"] != "gene")

        def of(gene: Column) -> Column:
            def rank(r: Column) -> Column:
                same, before = r["clause"] == gene["clause"], r["at"] < gene["at"]
                return F.struct(
                    (~same).alias("other"), (~same & before).alias("back"), F.abs(r["at"] - gene["at"]).alias("far"), before.alias("before"), (r["kind"] == "positive").alias("mutated")
                )

            return F.struct(gene["name"].alias("gene"), F.array_min(F.transform(results, rank))["mutated"].alias("mutated"))

        return F.transform(F.filter(found, lambda m: m["kind"] == "gene"), of)

    found = F.aggregate(parts, first.cast(state), step, lambda acc: acc["found"])
    pairs = F.flatten(F.transform(F.array(found), bound))
    return F.array_distinct(F.filter(pairs, lambda p: p["mutated"].isNotNull()))


def sentences_of(text: Column | str) -> Column:
    """Sentences and lines of a text in order, blank ones left out."""
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.transform(F.split(c, r"(?<=[.;!?])\s+|\n+"), X.strip_blank), lambda s: s != "")


def rule_findings(
    text: Column | str,
    document_date: Column | str,
    genes: Sequence[str] = GENES,
    mutated: Sequence[str] = MUTATED_PHRASES,
    wildtype: Sequence[str] = WILDTYPE_PHRASES,
    negators: Sequence[str] = NEGATORS,
    sentences: Column | None = None,
) -> dict[str, Column]:
    """Baseline extraction from the whole text, sentence by sentence, without Python.

    ``sentences`` may give those of the text where they are at hand.

    Genes count where ``gene_results`` finds a result for them. Karyotypes come from sentences that
    name them, risk categories only where stated. Findings stand in the order of their sentences,
    which are kept whole as evidence; the date is that of the sentence, without one that of the
    document.
    """

    def date_of(s: Column) -> Column:
        # Bound once as an element, as the first date is looked at many times.
        return F.get(F.transform(F.array(X.date_in(s)), lambda d: X.normalise_finding_date(F.nullif(d, F.lit("")), document_date)), 0)

    sentences = sentences_of(text) if sentences is None else sentences
    # Only sentences with a gene and a result are looked at closer.
    any_gene = _BEFORE + _one_of(genes) + _AFTER
    any_result = f"(?iu){_BEFORE}{_one_of([*mutated, *wildtype])}"
    stated = F.transform(
        F.filter(sentences, lambda s: s.rlike(any_gene) & s.rlike(any_result)),
        lambda s: F.struct(s.alias("s"), date_of(s).alias("date"), gene_results(s, genes, mutated, wildtype, negators).alias("found")),
    )

    def genes_in(x: Column) -> Column:
        return F.transform(
            x["found"],
            lambda g: F.struct(
                g["gene"].alias("gene"),
                g["mutated"].alias("mutated"),
                F.lit(None).cast("string").alias("variant_detail"),
                x["date"].alias("date"),
                x["s"].alias("evidence_text"),
            ),
        )

    def classify(s: Column) -> Column:
        low = F.lower(s)
        return (
            F.when(low.rlike("nicht durchgeführt|ausstehend|steht aus"), F.lit("not_performed"))
            .when(low.contains("komplex"), F.lit("complex_aberrant"))
            .when(low.rlike("unauffällig|normaler") | s.rlike(r"46,X[XY](\[|[\s.;]|$)"), F.lit("normal"))
            .when(low.contains("aberrant") | s.rlike(r"\b(t|del|inv|ins)\(|4[0-9],X[XY]?,"), F.lit("aberrant"))
            .otherwise(F.lit("unknown"))
        )

    karyo = F.filter(sentences, lambda s: s.rlike(r"(?i)karyotyp|zytogenetik|\b4[0-9],X[XY]?\b"))
    risk = F.filter(
        sentences,
        lambda s: s.rlike(r"(?i)\bELN\b|risikogruppe")
        & s.rlike(r"(?i)günstig|intermedi|adverse|favou?rable|\bhoch|high-risk"),
    )

    def category(s: Column) -> Column:
        return (
            F.when(s.rlike(r"(?i)ungünstig|adverse|\bhoch|high-risk"), F.lit("adverse"))
            .when(s.rlike(r"(?i)intermedi"), F.lit("intermediate"))
            .otherwise(F.lit("favorable"))
        )

    return {
        "genes": F.flatten(F.transform(stated, genes_in)),
        "karyotypes": F.transform(
            karyo,
            lambda s: F.struct(
                s.alias("raw_text"),
                classify(s).alias("classification"),
                date_of(s).alias("date"),
                s.alias("evidence_text"),
            ),
        ),
        "eln_risk": F.transform(
            risk,
            lambda s: F.struct(
                category(s).alias("risk_category"),
                s.alias("raw_text"),
                date_of(s).alias("date"),
                s.alias("evidence_text"),
            ),
        ),
        "notes": F.lit(None).cast("string"),
    }


Extractor = Callable[[dict], dict]
MAX_RETRIES = 3


def extract_findings(
    letters: DataFrame,
    extractor: Extractor | None = None,
    done: DataFrame | None = None,
    key: str = "letter_key",
) -> DataFrame:
    """Findings of all letters not in ``done``.

    Without ``extractor`` the rules above apply, as plain expressions. An extractor gets one letter
    as a dict and returns genes, karyotypes, eln_risk and notes; an empty result is tried again up
    to three times, and an exception becomes a row with ``error`` instead of failing the job.
    """
    todo = letters if done is None else letters.join(done.select(key), key, "left_anti")
    prompted = letter_prompt(todo)
    if extractor is None:
        split = _once(prompted, {"_sentences": sentences_of("prompt")})
        found = _once(split, rule_findings("prompt", "document_date", sentences=F.col("_sentences"))).drop("_sentences")
        return found.withColumns({"attempts": F.lit(1), "error": F.lit(None).cast("string")})

    names, retries = prompted.columns, MAX_RETRIES
    arrays = ["genes", "karyotypes", "eln_risk"]

    # Self-contained, so that executors need nothing but pandas and the extractor itself.
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pandas

        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                letter = {k: (None if v is None or v != v else v) for k, v in row.items()}
                result, error, attempts = {}, None, 0
                try:
                    while attempts <= retries:
                        attempts += 1
                        result = extractor(letter)
                        if any(result.get(a) for a in arrays):
                            break
                except Exception as e:  # a bad letter must not stop the others
                    result, error = {}, f"{type(e).__name__}: {e}"
                out.append(
                    [letter[n] for n in names]
                    + [result.get(a) or [] for a in arrays]
                    + [result.get("notes"), attempts, error]
                )
            yield pandas.DataFrame(out, columns=[*names, *arrays, "notes", "attempts", "error"])

    letter_ddl = ", ".join(f"`{n}` {t}" for n, t in prompted.dtypes)
    return prompted.mapInPandas(run, f"{letter_ddl}, {RESULT_DDL}, attempts int, error string")


# Date form and categories of valid findings.
DATE_PATTERN = r"^[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?$"
CLASSIFICATIONS = ["normal", "aberrant", "complex_aberrant", "not_performed", "unknown"]
RISK_CATEGORIES = ["favorable", "intermediate", "adverse"]


def _fits(c: Column, limit: int, required: bool = False) -> Column:
    ok = F.length(c) <= limit
    return F.coalesce(ok, F.lit(not required))


def _date_ok(d: Column) -> Column:
    return F.coalesce(d.rlike(DATE_PATTERN), F.lit(True))


def finding_problems(df: DataFrame) -> Column:
    """Names of the limits a result breaks; an empty array means valid."""

    def bad(array: str, test: Callable[[Column], Column]) -> Column:
        return F.coalesce(F.exists(array, lambda x: ~test(x)), F.lit(False))

    def count_over(array: str, n: int) -> Column:
        return F.coalesce(F.size(array) > n, F.lit(False))

    checks = {
        "gene_length": bad("genes", lambda g: _fits(g["gene"], 50, True)),
        "gene_status": bad("genes", lambda g: g["mutated"].isNotNull()),
        "detail_length": bad("genes", lambda g: _fits(g["variant_detail"], 100)),
        "gene_date": bad("genes", lambda g: _date_ok(g["date"])),
        "gene_evidence": bad("genes", lambda g: _fits(g["evidence_text"], 300)),
        "gene_count": count_over("genes", 20),
        "karyotype_text": bad("karyotypes", lambda k: _fits(k["raw_text"], 300, True)),
        "karyotype_class": bad(
            "karyotypes", lambda k: F.coalesce(k["classification"].isin(CLASSIFICATIONS), F.lit(False))
        ),
        "karyotype_date": bad("karyotypes", lambda k: _date_ok(k["date"])),
        "karyotype_evidence": bad("karyotypes", lambda k: _fits(k["evidence_text"], 300)),
        "karyotype_count": count_over("karyotypes", 10),
        "risk_text": bad("eln_risk", lambda e: _fits(e["raw_text"], 200, True)),
        "risk_category": bad(
            "eln_risk", lambda e: F.coalesce(e["risk_category"].isin(RISK_CATEGORIES), F.lit(False))
        ),
        "risk_date": bad("eln_risk", lambda e: _date_ok(e["date"])),
        "risk_evidence": bad("eln_risk", lambda e: _fits(e["evidence_text"], 300)),
        "risk_count": count_over("eln_risk", 5),
        "notes_length": ~_fits(F.col("notes"), 500),
    }
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in checks.items()]))


# Limits of single findings: problem name and test of one finding, by array.
_SINGLE: dict[str, dict[str, Callable[[Column], Column]]] = {
    "genes": {
        "gene_length": lambda g: _fits(g["gene"], 50, True),
        "gene_status": lambda g: g["mutated"].isNotNull(),
        "detail_length": lambda g: _fits(g["variant_detail"], 100),
        "gene_date": lambda g: _date_ok(g["date"]),
        "gene_evidence": lambda g: _fits(g["evidence_text"], 300),
    },
    "karyotypes": {
        "karyotype_text": lambda k: _fits(k["raw_text"], 300, True),
        "karyotype_class": lambda k: F.coalesce(k["classification"].isin(CLASSIFICATIONS), F.lit(False)),
        "karyotype_date": lambda k: _date_ok(k["date"]),
        "karyotype_evidence": lambda k: _fits(k["evidence_text"], 300),
    },
    "eln_risk": {
        "risk_text": lambda e: _fits(e["raw_text"], 200, True),
        "risk_category": lambda e: F.coalesce(e["risk_category"].isin(RISK_CATEGORIES), F.lit(False)),
        "risk_date": lambda e: _date_ok(e["date"]),
        "risk_evidence": lambda e: _fits(e["evidence_text"], 300),
    },
}


def _sound(array: str) -> Callable[[Column], Column]:
    def test(x: Column) -> Column:
        out = F.lit(True)
        for check in _SINGLE[array].values():
            out = out & check(x)
        return out

    return test


def sound_findings(df: DataFrame) -> DataFrame:
    """Results without the single findings that break a limit; no letter goes with them."""
    return df.withColumns({a: F.filter(a, _sound(a)) for a in _SINGLE})


def _broken(array: str, checks: dict[str, Callable[[Column], Column]]) -> Column:
    def described(f: Column) -> Column:
        names = F.array_compact(F.array(*[F.when(~check(f), F.lit(n)) for n, check in checks.items()]))
        return F.struct(F.lit(array).alias("kind"), F.array_join(names, ",").alias("problems"), F.to_json(f).alias("finding"))

    sound = _sound(array)
    found = F.transform(F.filter(array, lambda f: ~sound(f)), described)
    return F.coalesce(found, F.array().cast("array<struct<kind:string,problems:string,finding:string>>"))


def rejected_single_findings(df: DataFrame, key: str = "letter_key") -> DataFrame:
    """``kind``, ``problems`` and the whole finding as JSON for each finding that breaks a limit."""
    kinds = [_broken(array, checks) for array, checks in _SINGLE.items()]
    # One list of all kinds: the findings of a letter are worked out once for all of them.
    return df.select(key, F.inline(F.concat(*kinds)))


def unique_findings(df: DataFrame) -> DataFrame:
    """Each gene, classification and risk category of a letter once: the earliest dated one, undated
    ones last, then the first in the text."""

    def once(array: str, name: str) -> Column:
        placed = F.transform(
            array, lambda x, i: F.struct(x["date"].isNull().alias("undated"), x["date"].alias("date"), i.alias("at"), x.alias("f"))
        )
        ordered = F.transform(F.array_sort(placed), lambda x: x["f"])

        def first_of_each(found: Column) -> Column:
            names = F.transform(found, lambda y: y[name])
            return F.filter(found, lambda x, i: F.array_position(names, x[name]) == i + 1)

        # Bound once as an element; written out, it would be worked out again for each finding.
        return F.get(F.transform(F.array(ordered), first_of_each), 0)

    keys = {"genes": "gene", "karyotypes": "classification", "eln_risk": "risk_category"}
    return df.withColumns({a: F.when(F.col(a).isNotNull(), once(a, n)) for a, n in keys.items()})


def validate_findings(df: DataFrame) -> DataFrame:
    """Add ``problems``; split with ``valid_findings`` and ``rejected_findings``."""
    return df.withColumn("problems", finding_problems(df))


def valid_findings(df: DataFrame) -> DataFrame:
    return df.where(F.size("problems") == 0).drop("problems")


def rejected_findings(df: DataFrame) -> DataFrame:
    return df.where(F.size("problems") > 0)


# Columns of the finding tables.
METADATA = ["patient_mrn", "account_id", "document_date", "letter_status", "template_name", "source_type", "source_file"]
FINDING_FIELDS = {
    "genes": ["gene", "date", "mutated", "variant_detail", "evidence_text"],
    "karyotypes": ["raw_text", "date", "classification", "evidence_text"],
    "eln_risk": ["raw_text", "date", "risk_category", "evidence_text"],
}


def findings_tables(results: DataFrame, source_file: str = "letter_key") -> dict[str, DataFrame]:
    """Genes, karyotypes and risks as flat rows with the letter's metadata; missing text is ''."""
    meta = {
        "patient_mrn": F.col("patient_id"),
        "source_type": F.col("source_type"),
        "source_file": F.col(source_file),
    }
    for c in METADATA:
        meta.setdefault(c, F.coalesce(F.col(c), F.lit("")))
    out = {}
    for name, fields in FINDING_FIELDS.items():
        rows = results.withColumn("_f", F.explode(name))
        cells = []
        for f in fields:
            value = F.col(f"_f.{f}")
            required = f in ("gene", "mutated", "raw_text", "classification", "risk_category")
            cells.append((value if required else F.coalesce(value, F.lit(""))).alias(f))
        out[name] = rows.select(*[meta[c].alias(c) for c in METADATA], *cells)
    return out


def dedupe_genes(genes: DataFrame, letter: str = "source_file") -> DataFrame:
    """One entry per letter and gene: the earliest status; undated ones come last."""
    dated = F.nullif(F.col("date"), F.lit(""))
    return top_per_key(
        genes,
        [letter, "gene"],
        [dated.asc_nulls_last(), F.col("mutated").desc(), F.col("evidence_text")],
    )


def distinct_assessments(findings: DataFrame, letter: str, value: str) -> DataFrame:
    """Karyotypes or risks: each distinct assessment of a letter once."""
    return top_per_key(
        findings, [letter, value, "date"], [F.col("raw_text").asc(), F.col("evidence_text").asc()]
    )


def rebuild_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The three tables again from saved JSON results."""
    letter_ddl = ", ".join(f"{c} string" for c in [*LETTER_COLUMNS, "letter_key"])
    saved = spark.read.schema(f"{letter_ddl}, {RESULT_DDL}").json(path)
    return findings_tables(saved)
