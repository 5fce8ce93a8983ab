"""Word lists, patterns, thresholds and texts the results depend on."""

# --- fixed values: character classes (the same spelling works in Java and RE2) ---
SPACE = r"[\s\p{Z}\x{0B}\x{1C}-\x{1F}\x{85}]"
WORD = r"[\p{L}\p{N}_]"

# --- fixed values: redaction patterns and marks ---
SSN = r"\b\d{3}-\d{2}-\d{4}\b"
SSN_MARK = "[REDACTED_SSN]"
PHONE = r"\b\d{3}-\d{3}-\d{4}\b"
PHONE_MARK = "[REDACTED_PHONE]"

# --- fixed values: topics and their keywords ---
TOPIC_KEYWORDS = {
    "technology": ["software", "hardware", "computer", "tech", "digital", "ai", "machine learning"],
    "science": ["research", "study", "experiment", "scientific", "discovery", "theory"],
    "business": ["company", "market", "revenue", "business", "strategy", "investment"],
    "health": ["health", "medical", "disease", "treatment", "patient", "doctor"],
    "education": ["education", "learning", "school", "university", "student", "course"],
    "politics": ["government", "political", "election", "policy", "law", "legislation"],
}

# --- fixed values: path segment -> document category ---
PATH_CATEGORIES = {
    "/technical/": "technical_docs",
    "/research/": "research_papers",
    "/policies/": "policies",
    "/reddit/": "reddit_data",
}

# --- fixed values: review quality patterns ---
PRODUCT_PATTERN = "product|item|purchase"
OPINION_PATTERN = "like|love|hate|good|bad|great|terrible|excellent|poor|recommend"
PROFANITY_PATTERN = "badword1|badword2"

# --- fixed values: survey ratings ---
RATING_VALUES = {
    "Very Dissatisfied": 1,
    "Dissatisfied": 2,
    "Neutral": 3,
    "Satisfied": 4,
    "Very Satisfied": 5,
}

# --- fixed values: sentiment labels ---
SENTIMENTS = ["POSITIVE", "NEGATIVE", "NEUTRAL", "MIXED"]

# --- fixed values: performance bands, lower bound first-to-last ---
BANDS = {
    "Precision": [("Excellent", 0.8), ("Good", 0.6), ("Acceptable", 0.4)],
    "Recall": [("Excellent", 0.7), ("Good", 0.5), ("Acceptable", 0.3)],
    "F1 Score": [("Excellent", 0.7), ("Good", 0.5), ("Acceptable", 0.3)],
}

# --- fixed values: embedding quality limits: metric -> (compare, limit, verdict otherwise) ---
EMBEDDING_LIMITS = {
    "contrast": (">", 0.15, "Needs Improvement"),
    "clustering_quality": (">", 0.05, "Needs Improvement"),
    "relevance_score": (">", 0.10, "Needs Improvement"),
    "avg_similar": (">", 0.50, "Moderate"),
    "avg_dissimilar": ("<", 0.40, "Moderate"),
}

# --- fixed values: substring-triggered expansions ---
TRIGGER_EXPANSIONS = {
    "ai": ["artificial intelligence", "machine learning", "deep learning"],
    "ml": ["machine learning", "ai", "neural networks"],
    "python": ["programming", "coding", "development"],
    "data": ["dataset", "information", "analytics"],
    "science": ["research", "scientific", "study"],
    "tech": ["technology", "technical", "digital"],
}

# --- fixed values: domain synonyms ---
DOMAIN_SYNONYMS = {
    "bautismo": ["bautizo", "sacramento", "cristianar"],
    "parroquia": ["iglesia", "templo", "parish"],
    "registro": ["libro", "acta", "asentamiento"],
    "población": ["feligresía", "habitantes", "vecinos"],
    "natalidad": ["nacimiento", "natividad", "alumbramiento"],
    "año": ["periodo", "época", "tiempo"],
    "cura": ["párroco", "sacerdote", "clérigo"],
    "libro": ["registro", "documento", "archivo"],
    "español": ["castellano", "peninsular"],
    "mestizo": ["mixed", "criollo"],
    "indio": ["indígena", "natural"],
    "feligresía": ["parish", "población", "comunidad"],
}

# --- fixed values: intents and their keywords, in order of preference on ties ---
INTENT_KEYWORDS = {
    "factual": ["quién", "who", "dónde", "where", "cuándo", "when", "existe", "exists"],
    "comparative": ["comparar", "compare", "diferencia", "difference", "versus", "vs"],
    "aggregation": ["cuántos", "how many", "total", "contar", "count", "suma", "sum"],
    "temporal": ["durante", "during", "período", "period", "tendencia", "trend", "cambio", "change"],
    "analytical": ["por qué", "why", "cómo", "how", "relación", "relationship", "patrón", "pattern"],
}
DEFAULT_INTENT = ("factual", 0.5)

# --- fixed values: complexity indicators (regular expressions on lower-cased text) ---
COMPLEXITY_PATTERNS = [
    " y ", " and ", " o ", " or ", "?.*?", "comparar", "compare", "luego", "then", "después", "after",
    "primero.*segundo", "first.*second", "además", "also", "también",
]
COMPLEX_WORDS = 20

# --- fixed values: conjunctions that split a query, in order ---
SPLIT_CONJUNCTIONS = [" y luego ", " and then ", " además ", " also "]

# --- fixed values: signs of a dependent sub-query in a generated list ---
LIST_DEPENDENCY_WORDS = ["based on", "usando", "with", "from above"]

# --- fixed values: signs that a sub-query refers to an earlier step ---
REFERENCE_MARKERS = [
    "based on", "usando", "from above", "anterior", "the", "ese", "esa", "esos", "esas", "them", "those",
]

# --- fixed values: spelling normalisations, applied in this order ---
NORMALISATIONS = {
    "bautiso": "bautizo",
    "yglesia": "iglesia",
    "fransiscano": "franciscano",
    "parroquia": "parroquia",
    "Sn": "San",
    "Sta": "Santa",
    "Dr": "Doctor",
    "Fr": "Fray",
    "año": "año",
    "1600s": "siglo XVII",
    "1700s": "siglo XVIII",
}

# --- fixed values: question pattern -> statement with numbered groups ---
QUESTION_FORMS = [
    (r"¿?Quién (fue|es|era) (.+)\?", "{2}"),
    (r"¿?Dónde (fue|es|era) (.+)\?", "lugar de {2}"),
    (r"¿?Cuándo (fue|es|era) (.+)\?", "fecha de {2}"),
    (r"¿?Qué (.+)\?", "{1}"),
    (r"¿?Cuántos (.+)\?", "número de {1}"),
    (r"Who (was|is|were) (.+)\?", "{2}"),
    (r"Where (was|is|were) (.+)\?", "location of {2}"),
    (r"When (was|is|were) (.+)\?", "date of {2}"),
    (r"What (.+)\?", "{1}"),
    (r"How many (.+)\?", "number of {1}"),
]

# --- fixed values: context added to short queries ---
CONTEXT_TERMS = ["registro de bautismo", "Nueva España", "período colonial"]
COUNTING_TERMS = ["total", "count", "number"]
CONTEXT_SUFFIX = " en registros de bautismo colonial"

# --- fixed values: entity patterns (case is ignored) ---
ENTITY_PATTERNS = {
    "names": r"[A-Z][a-zá-ú]+ [A-Z][a-zá-ú]+",
    "places": r"San [A-Z][a-zá-ú]+|Santa [A-Z][a-zá-ú]+",
    "dates": r"\d{4}|\d{1,2} de [a-z]+ de \d{4}",
    "roles": r"padre|franciscano|dominico|párroco",
}

# --- fixed values: gate thresholds ---
QUALITY_GATES = {
    "faithfulness": 0.80,
    "answer_relevancy": 0.75,
    "context_precision": 0.70,
    "context_recall": 0.65,
    "answer_correctness": 0.70,
}

# --- fixed values: retrieval strategies under test ---
STRATEGIES = [("High Precision", 0.9, 0.7), ("Balanced", 0.7, 0.5), ("High Recall", 0.5, 0.3)]

# --- fixed values: notice when nothing similar is on file ---
NO_MATCH_NOTICE = (
    "Info: No matching historical fraudulent claims found in the database for the given text."
)

# --- fixed values: seconds of an alarm period ---
ALARM_PERIOD_SECONDS = 300

# --- fixed values: two-sided 95 % normal quantile ---
Z95 = 1.959963984540054

# --- fixed values: texts around the sources and the question in a prompt ---
PROMPT_HEAD = (
    "You are a helpful AI assistant that answers questions based on provided context from Reddit posts."
    "\n\nContext Information:\n"
)
PROMPT_RULES = (
    "\n\nInstructions:\n"
    "- Answer the question using ONLY the information from the provided context\n"
    "- If the context doesn't contain enough information, say so\n"
    "- Cite your sources by referencing [Source N] numbers\n"
    "- Be concise and accurate\n"
    "- If you see conflicting information, acknowledge it\n\n"
)
