"""Letters (group L) against SQL. Pages and documents stand for the letters; texts are whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from cohortloom.functions import text as X
from cohortloom.operators import letters as LT

# SQL forms of the text cascade.


def strip_sql(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def untag_sql(c: str) -> str:
    return f"regexp_replace({c}, '<[^>]*>', '', 'g')"


def decode_sql(c: str) -> str:
    for name, char in [("nbsp", " "), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "''"), ("#39", "''"), ("copy", "©"), ("middot", "·"), ("amp", "&")]:
        c = f"replace({c}, '&{name};', '{char}')"
    return c


def html_sql(c: str) -> str:
    for pattern, new in [
        (r"(?is)<!--.*?-->", "''"),
        (r"(?is)<script\b[^>]*>.*?</script\s*>", "''"),
        (r"(?is)<style\b[^>]*>.*?</style\s*>", "''"),
        (r"(?i)<br\s*/?>", "chr(10)"),
        (r"(?i)<h1\b[^>]*>", "chr(10) || chr(10) || '# '"),
        (r"(?i)<h2\b[^>]*>", "chr(10) || chr(10) || '## '"),
        (r"(?i)<h3\b[^>]*>", "chr(10) || chr(10) || '### '"),
        (r"(?i)<li\b[^>]*>", "chr(10) || '- '"),
        (r"(?i)</?(p|div|section|article|table|ul|ol|h[1-6]|tr)\b[^>]*>", "chr(10) || chr(10)"),
        ("<[^>]*>", "''"),
    ]:
        c = f"regexp_replace({c}, '{pattern}', {new}, 'g')"
    c = decode_sql(c)
    c = f"regexp_replace({c}, '[ \\t]+', ' ', 'g')"
    c = f"regexp_replace({c}, ' ?\\n ?', chr(10), 'g')"
    c = f"regexp_replace({c}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return strip_sql(c)


query("html_to_text", f"SELECT page_id, {html_sql('html')} AS text FROM pages")(
    lambda t: t.pages.select("page_id", X.html_to_text("html").alias("text"))
)

XML = """concat('<Document><SECTION class="a" ID="M5_Therapie"><h>', lang, '</h><content>', text, '</content><CONTENT> </CONTENT>',
    '<content>', source, ' &amp; more</content></SECTION></stray>',
    CASE WHEN doc_id % 3 = 0 THEN concat('<section id="M5_Diagnosen"><content>diag ', lang, '</content></section>') ELSE '' END, '</Document>')"""
NO_THERAPY = "CASE WHEN doc_id % 5 = 0 THEN replace({xml}, 'M5_Therapie', 'M5_Other') ELSE {xml} END".format(xml=XML)
THERAPY_SQL = f"concat_ws(chr(10) || chr(10), nullif({strip_sql(decode_sql(untag_sql('text')))}, ''), concat(source, ' & more'))"

query(
    "html_sections",
    f"""SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN {THERAPY_SQL} END AS therapy,
        CASE WHEN doc_id % 3 = 0 THEN concat('diag ', lang) END AS diagnosis FROM documents""",
)(
    lambda t: t.documents.selectExpr("doc_id", f"{NO_THERAPY} AS xml").select(
        "doc_id",
        X.extract_section("xml", "M5_Therapie").alias("therapy"),
        X.extract_section("xml", "M5_Diagnosen").alias("diagnosis"),
    )
)


def documents(t):
    """XML letters around the given texts."""
    return t.documents.selectExpr(
        f"{NO_THERAPY} AS xmldocument",
        "doc_id AS patid",
        "concat('A ', doc_id % 7) AS patientaccountid",
        "CASE WHEN doc_id % 2 = 0 THEN '2019-12-13' ELSE '' END AS lastsaveddatetime",
        "'final' AS letterstatus",
        "source AS templatename",
    )


LETTERS_SQL = f"""SELECT doc_id, cast(doc_id as varchar) AS patient_id, concat('A ', doc_id % 7) AS account_id,
    CASE WHEN doc_id % 2 = 0 THEN '2019-12-13' END AS document_date, source AS template_name,
    {html_sql(THERAPY_SQL)} AS therapie_text, CASE WHEN doc_id % 3 = 0 THEN concat('diag ', lang) END AS diagnosis_text
    FROM documents WHERE doc_id % 5 <> 0"""

query(
    "letters_from_documents",
    f"SELECT patient_id, account_id, document_date, template_name, therapie_text, diagnosis_text FROM ({LETTERS_SQL})",
)(
    lambda t: LT.letters_from_documents(documents(t)).select(
        "patient_id", "account_id", "document_date", "template_name", "therapie_text", "diagnosis_text"
    )
)

# An undated letter has the whole digest of its content in the place of the date.
query(
    "letter_keys",
    """SELECT concat_ws('_', cast(doc_id as varchar), concat('A-', doc_id % 7), CASE WHEN doc_id % 2 = 0 THEN '2019-12-13' ELSE 'digest' END) AS letter_key FROM documents WHERE doc_id % 5 <> 0""",
)(
    lambda t: LT.letter_key(LT.letters_from_documents(documents(t))).select(
        F.regexp_replace("letter_key", "_[0-9a-f]{64}$", "_digest").alias("letter_key")
    )
)

query(
    "skipped_documents",
    "SELECT count(*) AS documents, count(*) FILTER (doc_id % 5 = 0) AS skipped FROM documents",
)(lambda t: LT.skipped_documents(documents(t)))

# The documents' own texts with signs and letters written as references; later ones hold no earlier sign.
REFERENCES = [("&", "&amp;"), ("<", "&lt;"), (">", "&GT;"), ("e", "&#x65;"), ("ü", "&uuml;"), ("é", "&eacute;"), ("ä", "&#228;"), ("ß", "&#223;"), ("α", "&alpha;")]


def referenced(text: str) -> str:
    for sign, reference in REFERENCES:
        text = f"replace({text}, '{sign}', '{reference}')"
    return text


query("entities_decoded", "SELECT doc_id, replace(text, chr(160), ' ') AS text FROM documents")(
    lambda t: t.documents.select("doc_id", X.decode_entities(F.expr(referenced("text"))).alias("text"))
)


def nested_sql(*parts: str) -> str:
    return "nullif(concat_ws(chr(10) || chr(10), " + ", ".join(f"nullif({p}, '')" for p in parts) + "), '')"


_TEXT_SQL = strip_sql("replace(text, chr(160), ' ')")
query("nested_sections", f"SELECT doc_id, {nested_sql('source', _TEXT_SQL, 'lang')} AS outer_text, {nested_sql(_TEXT_SQL)} AS inner_text FROM documents")(
    lambda t: t.documents.selectExpr(
        "doc_id",
        f"""concat('<d><SECTION ID="a"><content>', source, '</content><section id="b"><content title="x>y">', coalesce({referenced("text")}, ''),
            '</content></section><content>', lang, '</content></SECTION><section><content>four</content></section></d>') AS page""",
    ).select("doc_id", X.extract_section("page", "a").alias("outer_text"), X.extract_section("page", "b").alias("inner_text"))
)

query(
    "letter_key_collisions",
    """SELECT concat_ws('_', cast(doc_id % 40 as varchar), concat('A-', doc_id % 7), '2019-12-13') AS letter_key, count(*) AS n FROM documents
        WHERE doc_id % 2 = 0 AND doc_id % 5 <> 0 GROUP BY 1 HAVING count(*) > 1""",
)(
    lambda t: LT.key_collisions(
        LT.letter_key(
            LT.letters_from_documents(documents(t)).withColumn(
                "patient_id", (F.col("patient_id").cast("bigint") % 40).cast("string")
            )
        )
    )
)

query(
    "letter_prompts",
    f"""SELECT patient_id, concat_ws(chr(10) || chr(10), CASE WHEN document_date IS NOT NULL THEN concat('## Document date', chr(10), document_date) END,
        CASE WHEN diagnosis_text <> '' THEN concat('## Diagnosis summary', chr(10), diagnosis_text) END,
        CASE WHEN therapie_text <> '' THEN concat('## Therapy/follow-up timeline', chr(10), therapie_text) END) AS prompt FROM ({LETTERS_SQL})""",
)(lambda t: LT.letter_prompt(LT.letters_from_documents(documents(t))).select("patient_id", "prompt"))

ENTRY_MAP = {"histologie_text": "h", "molekularpatho_text": "m"}
query(
    "letters_from_entries",
    f"""SELECT patient_id, document_date, h AS histologie_text, m AS molekularpatho_text FROM (SELECT
        CASE WHEN conv_id % 11 > 0 THEN cast(conv_id as varchar) END AS patient_id, '2020-01-0' || (1 + turn % 5) AS document_date,
        nullif({strip_sql(untag_sql('CASE WHEN role = ' + "'user'" + ' THEN text END'))}, '') AS h,
        nullif({strip_sql(untag_sql('CASE WHEN turn % 3 = 0 THEN text END'))}, '') AS m FROM conversations)
        WHERE patient_id IS NOT NULL AND coalesce(h, m) IS NOT NULL""",
)(
    lambda t: LT.letters_from_entries(
        t.conversations.selectExpr(
            "CASE WHEN conv_id % 11 > 0 THEN concat('<b>', conv_id, '.0</>') END AS PatID",
            "concat('2020-01-0', 1 + turn % 5) AS Dokumentdatum",
            "CASE WHEN role = 'user' THEN concat('<F>', text, ' </>') END AS h",
            "CASE WHEN turn % 3 = 0 THEN concat(' ', text) END AS m",
        ),
        ENTRY_MAP,
    ).select("patient_id", "document_date", "histologie_text", "molekularpatho_text")
)

# The rules with words that occur in the given texts in place of genes and results.
WORDS = ["The", "und", "les", "Der", "and"]
POSITIVE = ["on", "ist", "et", "von"]
NEGATIVE = ["la", "die", "thth"]


def forms_sql(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}{e}'" for w in words for e in ("", "e", "er", "es", "en", "em")) + ")"


# Every word of every sentence with its place and its clause; then each gene ranks the results.
SENTENCES_SQL = f"""SELECT doc_id, row_number() OVER () AS sentence, s FROM (SELECT doc_id, {strip_sql("unnest(string_split_regex(regexp_replace(text, '([.;!?])\\s+', '\\1' || chr(1), 'g'), '\\x01|\\n+'))")} AS s FROM documents) WHERE s <> ''"""
PLACED_SQL = f"""SELECT *, CASE WHEN lower(w) IN {forms_sql(NEGATIVE)} THEN 'negative' WHEN lower(w) IN {forms_sql(POSITIVE)} THEN 'positive' WHEN w IN ({", ".join(f"'{w}'" for w in WORDS)}) THEN 'gene' END AS kind
    FROM (SELECT *, row_number() OVER (PARTITION BY sentence ORDER BY clause, i) AS at, words[i] AS w FROM
        (SELECT *, unnest(range(1, len(words) + 1)) AS i FROM
            (SELECT doc_id, sentence, s, clause, regexp_extract_all(clauses[clause], '[\\pL\\pN]+') AS words FROM
                (SELECT *, unnest(range(1, len(clauses) + 1)) AS clause FROM (SELECT *, string_split_regex(s, '[,;]') AS clauses FROM ({SENTENCES_SQL}))))))"""
GENES_SQL = f"""WITH placed AS MATERIALIZED (SELECT * FROM ({PLACED_SQL}) WHERE kind IS NOT NULL)
    SELECT DISTINCT ON (doc_id, sentence, gene, mutated) doc_id, gene, mutated, evidence_text FROM
        (SELECT g.doc_id, g.sentence, g.w AS gene, r.kind = 'positive' AS mutated, g.s AS evidence_text, row_number() OVER (PARTITION BY g.sentence, g.at ORDER BY
            r.clause <> g.clause, r.clause <> g.clause AND r.at < g.at, abs(r.at - g.at), r.at < g.at) AS rank
        FROM placed g JOIN placed r ON r.sentence = g.sentence AND g.kind = 'gene' AND r.kind <> 'gene') WHERE rank = 1"""


def genes(t):
    found = LT.rule_findings("text", F.lit("2020-05-01"), WORDS, POSITIVE, NEGATIVE, [])["genes"]
    return t.documents.select("doc_id", F.inline(found)).select("doc_id", "gene", "mutated", "evidence_text", "date")


query("rule_findings", f"SELECT *, '2020-05-01' AS date FROM ({GENES_SQL})")(genes)

query(
    "dedupe_genes",
    f"""SELECT doc_id, gene, mutated, evidence_text FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, gene ORDER BY mutated DESC, evidence_text) AS rn FROM ({GENES_SQL})) WHERE rn = 1""",
)(lambda t: LT.dedupe_genes(genes(t), "doc_id").drop("date"))

KARYO = """concat('Datum ', event_id, '. Zytogenetik (Labor X): ', CASE event_id % 6 WHEN 0 THEN 'komplex aberranter Karyotyp' WHEN 1 THEN 'unauffälliger Karyotyp'
    WHEN 2 THEN '46,XX' WHEN 3 THEN '46,XX,t(8;21)(q22;q22)[20]' WHEN 4 THEN 'nicht durchgeführt' ELSE 'Befund folgt' END, '. ELN-Risiko: ',
    CASE event_id % 4 WHEN 0 THEN 'intermediär' WHEN 1 THEN 'ungünstig' WHEN 2 THEN 'günstig' ELSE 'offen' END, '. NPM1 positiv.')"""
query(
    "karyotype_and_risk_rules",
    """SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'complex_aberrant' WHEN 1 THEN 'normal' WHEN 2 THEN 'normal' WHEN 3 THEN 'aberrant' WHEN 4 THEN 'not_performed' ELSE 'unknown' END AS classification,
        CASE event_id % 4 WHEN 0 THEN 'intermediate' WHEN 1 THEN 'adverse' WHEN 2 THEN 'favorable' END AS risk, 'NPM1' AS gene FROM events""",
)(
    lambda t: t.events.selectExpr("event_id", f"{KARYO} AS text")
    .withColumns(LT.rule_findings("text", F.lit(None).cast("string")))
    .select(
        "event_id",
        F.col("karyotypes")[0]["classification"].alias("classification"),
        F.get("eln_risk", F.lit(0))["risk_category"].alias("risk"),
        F.col("genes")[0]["gene"].alias("gene"),
    )
)

FINDING_DATE = """CASE event_id % 7 WHEN 0 THEN '12/19' WHEN 1 THEN '13.12.19' WHEN 2 THEN '2018' WHEN 3 THEN '3.4.2021' WHEN 4 THEN '01/2022' WHEN 5 THEN 'Mai' END"""
query(
    "normalise_finding_date",
    """SELECT event_id, CASE event_id % 7 WHEN 0 THEN '2019-12' WHEN 1 THEN '2019-12-13' WHEN 2 THEN '2018' WHEN 3 THEN '2021-04-03' WHEN 4 THEN '2022-01'
        ELSE strftime(ts, '%Y-%m-%d') END AS date FROM events""",
)(
    lambda t: t.events.selectExpr("event_id", f"{FINDING_DATE} AS text", "cast(ts as string) AS doc").select(
        "event_id", X.normalise_finding_date("text", "doc").alias("date")
    )
)

query(
    "vaf_to_mutated",
    "SELECT event_id, CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END AS mutated FROM events",
)(
    lambda t: t.events.selectExpr(
        "event_id", "CASE event_id % 4 WHEN 0 THEN '12,5 %' WHEN 1 THEN '0.0%' WHEN 2 THEN '0,1%' ELSE 'n/a' END AS v"
    ).select("event_id", X.vaf_to_mutated("v").alias("mutated"))
)


def results(t):
    """Extraction results of known shape, some of them beyond the limits."""
    none = F.lit(None).cast("string")
    gene = F.struct(
        F.expr("CASE WHEN event_id % 5 = 0 THEN repeat('G', 51) ELSE event_type END").alias("gene"),
        F.expr("event_id % 2 = 0").alias("mutated"),
        none.alias("variant_detail"),
        F.expr("CASE WHEN event_id % 7 = 0 THEN '12/19' ELSE '2019-12' END").alias("date"),
        none.alias("evidence_text"),
    )
    karyotype = F.struct(
        F.lit("46,XX").alias("raw_text"),
        F.expr("CASE WHEN event_id % 11 = 0 THEN 'odd' ELSE 'normal' END").alias("classification"),
        none.alias("date"),
        none.alias("evidence_text"),
    )
    risk = F.struct(
        F.lit("adverse").alias("risk_category"), F.lit("ELN: adverse").alias("raw_text"), none.alias("date"), none.alias("evidence_text")
    )
    return t.events.select(
        "event_id",
        F.array(gene).alias("genes"),
        F.when(F.expr("event_id % 3 = 0"), F.array(karyotype)).alias("karyotypes"),
        F.when(F.expr("event_id % 4 = 0"), F.array_repeat(risk, 6)).otherwise(F.array(risk)).alias("eln_risk"),
        none.alias("notes"),
        F.col("user_id").cast("string").alias("patient_id"),
        none.alias("account_id"),
        none.alias("document_date"),
        none.alias("letter_status"),
        none.alias("template_name"),
        F.lit("xml").alias("source_type"),
        F.concat(F.lit("letter-"), "event_id").alias("letter_key"),
    )


query(
    "validate_findings",
    """SELECT event_id, concat_ws(',', CASE WHEN event_id % 5 = 0 THEN 'gene_length' END, CASE WHEN event_id % 7 = 0 THEN 'gene_date' END,
        CASE WHEN event_id % 33 = 0 THEN 'karyotype_class' END, CASE WHEN event_id % 4 = 0 THEN 'risk_count' END) AS problems FROM events""",
)(lambda t: LT.validate_findings(results(t)).select("event_id", F.concat_ws(",", "problems").alias("problems")))

query(
    "rejected_findings",
    "SELECT event_id FROM events WHERE event_id % 5 = 0 OR event_id % 7 = 0 OR event_id % 33 = 0 OR event_id % 4 = 0",
)(lambda t: LT.rejected_findings(LT.validate_findings(results(t))).select("event_id"))

_META = "cast(user_id as varchar) AS patient_mrn, '' AS account_id, '' AS document_date, '' AS letter_status, '' AS template_name, 'xml' AS source_type, concat('letter-', event_id) AS source_file"
_VALID = "NOT (event_id % 5 = 0 OR event_id % 7 = 0 OR event_id % 33 = 0 OR event_id % 4 = 0)"
query(
    "findings_genes",
    f"SELECT {_META}, event_type AS gene, '2019-12' AS date, event_id % 2 = 0 AS mutated, '' AS variant_detail, '' AS evidence_text FROM events WHERE {_VALID}",
)(lambda t: LT.findings_tables(LT.valid_findings(LT.validate_findings(results(t))))["genes"])
query(
    "findings_karyotypes",
    f"SELECT {_META}, '46,XX' AS raw_text, '' AS date, 'normal' AS classification, '' AS evidence_text FROM events WHERE {_VALID} AND event_id % 3 = 0",
)(lambda t: LT.findings_tables(LT.valid_findings(LT.validate_findings(results(t))))["karyotypes"])
query(
    "findings_risks",
    f"SELECT {_META}, 'ELN: adverse' AS raw_text, '' AS date, 'adverse' AS risk_category, '' AS evidence_text FROM events WHERE {_VALID}",
)(lambda t: LT.findings_tables(LT.valid_findings(LT.validate_findings(results(t))))["eln_risk"])

query(
    "distinct_assessments",
    "SELECT event_id, 'adverse' AS risk_category, '' AS date FROM events",
)(
    lambda t: LT.distinct_assessments(
        results(t).select("event_id", F.explode("eln_risk").alias("r")).select(
            "event_id", "r.risk_category", F.coalesce("r.date", F.lit("")).alias("date"), "r.raw_text", "r.evidence_text"
        ),
        "event_id",
        "risk_category",
    ).select("event_id", "risk_category", "date")
)


def first_word_extractor():
    """A stand-in for a model: reports the first word of the letter as a gene."""

    def extract(letter: dict) -> dict:
        words = (letter.get("therapie_text") or "").split()
        if not words:
            return {}
        gene = {"gene": words[0][:50], "mutated": True, "variant_detail": None, "date": None, "evidence_text": None}
        return {"genes": [gene]}

    return extract


query(
    "extract_findings_with_callback",
    f"""SELECT patient_id, substr(regexp_extract(therapie_text, '^\\S+'), 1, 50) AS gene, 1 AS attempts FROM ({LETTERS_SQL})
        WHERE doc_id % 4 <> 0""",
)(
    lambda t: LT.extract_findings(
        LT.letters_from_documents(documents(t)).withColumn("letter_key", F.col("patient_id")),
        first_word_extractor(),
        t.documents.where("doc_id % 4 = 0").select(F.col("doc_id").cast("string").alias("letter_key")),
    ).select("patient_id", F.col("genes")[0]["gene"].alias("gene"), "attempts")
)
