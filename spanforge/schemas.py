"""Data model (StructTypes) and the fixed vocabularies of the annotated corpus.

Offsets everywhere are 0-based, half-open ``[start, stop)`` and count Unicode
code points (Spark's ``length``/``substring``/``locate`` count code points too).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the reference for identical results.
# ---------------------------------------------------------------------------
# Entity classes, id order 0, 1, 2.
CLASS_NAMES = ["Medikation", "Dosis", "Diagnose"]
# BIO tag vocabulary, id order 0..6.
BIO_TAGS = ["O", "B-Medikation", "I-Medikation", "B-Dosis", "I-Dosis",
            "B-Diagnose", "I-Diagnose"]
# Label id used for positions that are ignored by loss and metrics.
IGNORE_ID = -100
# Label templates (one per generated sentence), script version (7 shapes).
SHAPES = [
    ["Medikation"],
    ["Medikation", "Dosis"],
    ["Medikation", "Dosis", "Diagnose"],
    ["Diagnose"],
    ["Medikation", "Diagnose"],
    ["Medikation", "Dosis", "Medikation", "Dosis"],
    ["Diagnose", "Diagnose"],
]
# Label templates, notebook version (5 shapes).
SHAPES_NOTEBOOK = [
    ["Medikation", "Dosis"],
    ["Medikation", "Dosis", "Diagnose"],
    ["Diagnose"],
    ["Medikation", "Diagnose"],
    ["Medikation", "Dosis", "Diagnose", "Diagnose"],
]
# Random-shape draw lists: counts of medications, diagnoses, doses.
RANDOM_SHAPE_MED_COUNTS = [0, 1, 1, 2]
RANDOM_SHAPE_DIAG_COUNTS = [0, 1, 1, 2]
RANDOM_SHAPE_DOSE_COUNTS = [0, 1]
RANDOM_SHAPE_POOL_SIZE = 100
STYLES = [
    "ein vollständiger, grammatischer Satz",
    "eine knappe, telegrammartige Klinik-Notiz (kein voller Satzbau)",
    "eine Medikationszeile mit Dosierschema (z.B. 1-0-0, p.o.)",
    "eine Aussage aus Patientensicht (Ich-Form)",
    "ein Auszug aus einem Arztbrief",
]
CONTEXTS = ["Aufnahme", "Anamnese", "Verlauf", "Entlassung", "Befund", "Medikationsplan"]
# Fixed dosage values and units of the notebook dosage generator.
FIXED_DOSE_VALUES = ["2.5", "5", "10", "12.5", "20", "25", "40", "50", "100", "250", "500"]
FIXED_DOSE_UNITS = ["mg", "ug", "g", "ml", "IE"]
# Share of dosage texts written without a space between value and unit.
NO_SPACE_SHARE = 0.7
# Few-shot block header, task header, format blocks.
EXAMPLES_HEADER = "Beispiel Sätze:"
TASK_HEADER = "Begriffe:"
FORMAT_HEADER = "Format:"
FORMAT_LINES = {
    "script": '{"text": "...", "entities": [{"text": "...", "label": "Medikation|Dosis|Diagnose"}, ...]}',
    "notebook": '{"text": "...", "entities": [{"text": "...", "label": "Medikation|Dosis|Diagnose"}]}',
    "label_list": '{"text": "...", "label": ["Medikation|Dosis|Diagnose"], ...}\n',
}
STYLE_PREFIX = "Formuliere als: "
CONTEXT_PREFIX = "Kontext: "
# Fixed two-example few-shot block of the early notebook prompt.
FIXED_EXAMPLES = [
    '{"text":"0,5mg Digoxin 0,25mg Lanatoside","entities":[{"text":"0,5mg","label":"Dosis"},{"text":"Digoxin","label":"Medikation"},{"text":"0,25mg","label":"Dosis"},{"text":"Lanatoside","label":"Medikation"}]}',
    '{"text":"0,5mg Sildenafil bei erectilen Dysfunktion","entities":[{"text":"0,5mg","label":"Dosis"},{"text":"Sildenafil","label":"Medikation"},{"text":"erectilen Dysfunktion","label":"Diagnose"}]}',
]
# System instruction sent with every generation request (script version).
SYSTEM_PROMPT = (
    "Du erzeugst genau einen synthetischen deutschen medizinischen Satz für das Training eines NER-Modells.\n"
    "Verbindliche Regeln:\n"
    "1. Verwende jeden unter „Begriffe“ angegebenen Ausdruck exakt in der vorgegebenen Schreibweise, einschließlich Groß-/Kleinschreibung, Satzzeichen und Leerzeichen.\n"
    "2. Jeder vorgegebene Ausdruck muss im Feld „text“ genau einmal vorkommen.\n"
    "3. Verwende ausschließlich die vorgegebenen medizinischen Informationen.\n"
    "4. Ergänze keine weiteren Medikamente, Wirkstoffe, Dosierungen, Diagnosen, Symptome, Indikationen, Applikationswege, Darreichungsformen, Zeitangaben oder Behandlungseigenschaften.\n"
    "5. Allgemeine nichtmedizinische Funktionswörter und neutrale Satzbestandteile sind erlaubt.\n"
    "6. Erzeuge genau einen grammatisch vollständigen, plausiblen deutschen Satz.\n"
    "7. Erzeuge für jeden vorgegebenen Begriff genau einen Eintrag in „entities“.\n"
    "8. Der Wert von „entities.text“ muss exakt mit dem entsprechenden Ausdruck im Satz übereinstimmen.\n"
    "9. Die Einträge in „entities“ müssen in derselben Reihenfolge stehen, in der die Begriffe im Satz vorkommen.\n"
    "10. Verwende ausschließlich diese Labels: „Medikation“, „Dosis“ und „Diagnose“.\n"
    "11. Verwende keine Entität, die nicht in den Eingabebegriffen enthalten ist.\n"
    "12. Prüfe vor der Ausgabe intern:\n"
    "- Sind alle Begriffe exakt einmal enthalten?\n"
    "- Wurden keine medizinischen Informationen ergänzt?\n"
    "- Stimmen Text und Labels exakt überein?\n"
    "- Ist das JSON syntaktisch gültig?\n"
    "13. Antworte ausschließlich mit einem einzelnen gültigen JSON-Objekt. Kein Markdown, keine Erklärung und kein zusätzlicher Text.\n"
)
# System instruction of the variant without a format block: its last rule asks for
# the plain sentence.
SYSTEM_PROMPT_SENTENCE = SYSTEM_PROMPT.replace(
    "13. Antworte ausschließlich mit einem einzelnen gültigen JSON-Objekt. Kein Markdown, ",
    "13. Antworte ausschließlich mit einem einzelnen gültigen Satz, KEIN JSON. Kein Markdown, ")
# System instruction of the early fixed-example prompt.
SYSTEM_PROMPT_EARLY = (
    "Du erzeugst einzelne synthetische deutsche medizinische Saetze fuer das Training eines NER-Modells. Regeln:\n"
    "1. Verwende JEDEN vorgegebenen Begriff WORTWOERTLICH und unveraendert, genau einmal.\n"
    "2. Fuege KEINE weiteren Medikamente, Dosierungen oder Diagnosen hinzu.\n"
    "3. Schreibe genau EINEN natuerlichen, plausiblen Satz im angegebenen Stil.\n"
    "4. Antworte ausschliesslich mit JSON, ohne Markdown und ohne Kommentar."
)
# HTTP status codes worth a retry, attempts, base delay (seconds).
RETRYABLE_CODES = (429, 500, 502, 503, 504)
MAX_ATTEMPTS = 6
BASE_DELAY_S = 2.0
# Evaluation seeds.
SEEDS_A = [42, 123, 2024]
# ---------------------------------------------------------------------------

CLASS_TO_ID = {n: i for i, n in enumerate(CLASS_NAMES)}
BIO_TO_ID = {t: i for i, t in enumerate(BIO_TAGS)}

# M1 — canonical labelled sentence (HF ``Sequence`` of a dict = struct of lists).
NER_LABELS = T.StructType([
    T.StructField("ner_class", T.ArrayType(T.IntegerType())),
    T.StructField("start", T.ArrayType(T.IntegerType())),
    T.StructField("stop", T.ArrayType(T.IntegerType())),
])
LABELLED_SENTENCE = T.StructType([
    T.StructField("sentence", T.StringType()),
    T.StructField("ner_labels", NER_LABELS),
])
# M2 — offset record
OFFSET_RECORD = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("ent_starts", T.ArrayType(T.IntegerType())),
    T.StructField("ent_stops", T.ArrayType(T.IntegerType())),
    T.StructField("ent_classes", T.ArrayType(T.StringType())),
])
# M3 — entity mention
ENTITY = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("label", T.StringType()),
])
ENTITIES = T.ArrayType(ENTITY)
# M4 — character span
SPAN = T.StructType([
    T.StructField("start", T.IntegerType()),
    T.StructField("stop", T.IntegerType()),
    T.StructField("label", T.StringType()),
])
# M5 — token with offsets; token-aligned entity
TOKEN = T.StructType([
    T.StructField("i", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("start", T.IntegerType()),
    T.StructField("stop", T.IntegerType()),
    T.StructField("ws", T.BooleanType()),
])
TOKEN_ENT = T.StructType([
    T.StructField("first_tok", T.IntegerType()),
    T.StructField("last_tok", T.IntegerType()),
    T.StructField("start", T.IntegerType()),
    T.StructField("stop", T.IntegerType()),
    T.StructField("label", T.StringType()),
])
# M12 — parsed model response
RESPONSE_JSON = "struct<text:string,entities:array<struct<text:string,label:string>>>"
# M8 — dose list
DOSE_CSV = T.StructType([
    T.StructField("atc_code", T.StringType()),
    T.StructField("atc_name", T.StringType()),
    T.StructField("ddd", T.DoubleType()),
    T.StructField("uom", T.StringType()),
    T.StructField("adm_r", T.StringType()),
    T.StructField("note", T.StringType()),
])
# M14 — tidy metric record
METRIC_RECORD = T.StructType([
    T.StructField("seed", T.IntegerType()),
    T.StructField("scope", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

# FIXED VALUES — the twelve inline-tagged example sentences of the few-shot pool.
ORIGINAL_SENTENCES = [
    '<s>Zur weiteren Bekämpfung des <class="Diagnose">Juckreiz</class> wird die Einnahme von täglich <class="Dosis">100mg</class> <class="Medikation">Cortison</class> empfohlen.</s>',
    '<s>Bei wiederkehrender Infektion wie einer <class="Diagnose">Sepsis</class> oder schweren <class="Diagnose">Pnseumonien</class> wird eine Überwachung erforderlich sein.</s>',
    '<s><class="Medikation">Valsartan</class>/<class="Medikation">HCT</class> <class="Dosis">160</class>/<class="Dosis">12,5 mg</class> 1-0-0</s>',
    '<s><class="Medikation">Pantoprazol</class> <class="Dosis">40 mg</class> p.o.</s>',
    '<s>Die feingewebliche histopathologische Untersuchung ergab den Befund einer <class="Diagnose">Metastase</class> des bekannten malignen <class="Diagnose">Melanoms</class>.</s>',
    '<s><class="Diagnose">Diabetes Typ 2</class>-Patienten müssen regelmäßig <class="Medikation">Insulin</class> (mindestens mit <class="Dosis">12ml</class> dosiert) spritzen.</s>',
    '<s>Ich nehme <class="Medikation">Antibiotika</class> seit Tagen. Seitdem ist die <class="Diagnose">Mandelentzündung</class> deutlich besser geworden.</s>',
    '<s>Entlassung: <class="Dosis">40mg</class> <class="Medikation">Lidocain</class> wegen <class="Diagnose">Kopfschmerzen</class></s>',
    '<s>Zusammenfassende D: Zervix-PE bei 11 und 2 Uhr mit ausgeprägter <class="Diagnose">chronisch-florider Zervizitis</class>.</s>',
    '<s>Die Verschreibung von <class="Medikation">Hämatokrin</class> <class="Dosis">43mg</class> war unnötig.</s>',
    '<s>Der Patient klagt über <class="Diagnose">Karditiden</class> und nimmt täglich <class="Medikation">Nifedipin</class> ein.</s>',
    '<s>D: PE-Material der Portio bei 1 Uhr mit Nachweis einer schwergradigen <class="Diagnose">squamösen intraepithelialen Läsion</class> (<class="Diagnose">HSIL</class>; hier noch <class="Diagnose">CIN II</class>).</s>',
]
