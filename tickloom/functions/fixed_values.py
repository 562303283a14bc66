"""Vocabularies, patterns, limits and texts that define the results."""

# --- lookup tables: raw label -> class --------------------------------------
ISSUETYPE_MAPPING = {
    "Bug": "Bug",
    "Improvement": "Improvement",
    "Sub-task": "Sub-task",
    "New Feature": "New Feature",
    "Task": "Task",
    "Technical task": "Task",
    "Test": "Test",
    "Documentation": "Documentation",
    "Question": "Question",
    "Umbrella": "Other",
    "Wish": "Other",
    "Story": "Other",
    "Dependency upgrade": "Other",
    "Epic": "Other",
    "Brainstorming": "Other",
    "IT Help": "Other",
    "Request": "Other",
    "Github Integration": "Other",
    "Planned Work": "Other",
    "New JIRA Project": "Other",
    "Blog - New Blog Request": "Other",
    "Spike": "Other",
}
RESOLUTION_MAPPING = {
    "Fixed": "Fixed",
    "Done": "Fixed",
    "Resolved": "Fixed",
    "Implemented": "Fixed",
    "Won't Fix": "Won't Fix",
    "Won't Do": "Won't Fix",
    "Later": "Won't Fix",
    "Abandoned": "Won't Fix",
    "Not A Problem": "Not A Problem",
    "Not A Bug": "Not A Problem",
    "Works for Me": "Not A Problem",
    "Incomplete": "Incomplete",
    "Duplicate": "Duplicate",
    "Invalid": "Invalid",
    "Cannot Reproduce": "Cannot Reproduce",
}

# --- vocabularies -------------------------------------------------------------
ISSUETYPES = ["Bug", "Improvement", "Sub-task", "New Feature", "Task", "Test",
              "Documentation", "Question", "Other"]
RESOLUTIONS = ["Fixed", "Not A Problem", "Incomplete", "Duplicate", "Invalid",
               "Cannot Reproduce", "Won't Fix"]
SPLITS = ["train", "validation", "excluded"]
PRIORITIES_LOW_TO_HIGH = ["Trivial", "Minor", "Major", "Critical", "Blocker"]
PRIORITIES_REPORT_ORDER = ["Blocker", "Critical", "Major", "Minor", "Trivial"]
CHANGELOG_FIELDS = ["STATUS", "PRIORITY", "ASSIGNEE", "RESOLUTION", "FIX VERSION",
                    "FIX VERSION/S", "COMPONENT", "COMPONENT/S", "LABELS"]
VERSION_FIELDS = ["FIX VERSION", "FIX VERSION/S"]
VERSION_BRANCHES = ["1.x", "2.x", "3.x", "4.x"]
NULL_TOKENS = ["", "NULL", "nan", "NaN", "none", "None"]
NULL_TOKENS_SCRIPT = ["", "NULL", "nan", "NaN"]

# --- column contracts: header name -> landed name -----------------------------
ISSUE_COLUMNS = {
    "id": "id", "key": "key", "summary": "summary", "description": "description",
    "created": "created", "resolutiondate": "resolutiondate",
    "issuetype.name": "issuetype_name", "resolution.name": "resolution_name",
    "resolution.description": "resolution_description", "priority.name": "priority_name",
    "status.name": "status_name", "project.key": "project_key", "assignee": "assignee",
    "reporter": "reporter", "creator": "creator", "votes.votes": "votes_votes",
    "watches.watchCount": "watches_watchcount",
}
COMMENT_COLUMNS = {
    "key": "key", "comment.id": "comment_id", "comment.author": "comment_author",
    "comment.body": "comment_body", "comment.created": "comment_created",
    "comment.updated": "comment_updated",
}
CHANGELOG_COLUMNS = {
    "key": "key", "author": "author", "created": "created", "field": "field",
    "fromString": "fromstring", "toString": "tostring",
}
ISSUELINK_COLUMNS = {
    "key": "key", "type.name": "type_name", "inwardIssue.key": "inwardissue_key",
    "outwardIssue.key": "outwardissue_key",
}

# --- limits and dates -----------------------------------------------------------
MAX_DAYS = 5000
MIN_COMMENT_LENGTH = 10
COMMENT_SEPARATOR = " | "
COMMENT_LIMIT = 3000
TRAIN_BEFORE = "2023-01-01"
VALIDATION_BEFORE = "2024-01-01"
FEATURE_CLIP = 1e6

# --- text cleaning patterns, in order ---------------------------------------------
CLEANING_STEPS = [
    (r"<[^>]+>", " "),
    (r"(?si)\{code[^}]*\}(.{0,200}).*?\{code\}", "[CODE:$1]"),
    (r"(?si)\{noformat[^}]*\}(.{0,200}).*?\{noformat\}", "[CODE:$1]"),
    (r"\[~[^\]]+\]", " "),
    (r"https?://\S+", " "),
    (r"[\n\r\t ]{2,}", " "),
]
# Every match of every step begins with one of these.
CLEANING_BEGINS = r"[<{]|\[~|https?://|[\n\r\t ]{2}"

# --- feature lists --------------------------------------------------------------------
TABULAR_FEATURES_17 = [
    "n_total_changes", "n_status_changes", "n_priority_changes", "n_assignee_changes",
    "n_resolution_changes", "was_escalated", "n_people_involved", "n_links_total",
    "n_duplicates", "n_blocks", "n_blocked_by", "n_relates", "n_comments", "n_commenters",
    "resolution_days", "summary_length", "description_length",
]
TABULAR_FEATURES_19 = TABULAR_FEATURES_17 + ["n_container", "has_parent"]
# Known only once a ticket is closed: they give the label away.
LEAKING_FEATURES = ["resolution_days", "n_resolution_changes"]
TABULAR_FEATURES_SAFE = [c for c in TABULAR_FEATURES_19 if c not in LEAKING_FEATURES]
RARE_ISSUETYPES_5 = ["Task", "Documentation", "Test", "Question"]
RARE_ISSUETYPES_4 = ["Task", "Documentation", "New Feature", "Test", "Question"]
CLASSES_5 = ["Bug", "Improvement", "New Feature", "Other", "Sub-task"]
CLASSES_4 = ["Bug", "Improvement", "Other", "Sub-task"]
RESOLUTION_CLASSES = ["Cannot Reproduce", "Duplicate", "Fixed", "Incomplete", "Invalid",
                      "Not A Problem", "Won't Fix"]
RESOLUTION_REPORT_ORDER = ["Fixed", "Duplicate", "Won't Fix", "Not A Problem", "Invalid",
                           "Cannot Reproduce", "Incomplete"]

# --- keyword signals in a summary (first match wins) ----------------------------------
SUMMARY_SIGNALS = [
    (["fix", "bug", "error", "fail", "crash", "exception", "npe"], "[BUG-SIGNAL] "),
    (["improve", "enhance", "optimize", "performance", "refactor"], "[IMPROVEMENT-SIGNAL] "),
]

# --- keyword rules: words -> (type, resolution), first match wins -----------------------
PREDICTION_RULES = [
    (["memory", "leak", "crash", "error", "bug"], "Bug", "Fixed"),
    (["feature", "request", "roadmap"], "New Feature", "Incomplete"),
    (["duplicate"], "Sub-task", "Duplicate"),
]
PREDICTION_DEFAULT = ("Task", "Incomplete")

# --- recommendation texts ------------------------------------------------------------------
CONTEXT_RULES = [
    (["memory", "leak", "oom", "out of memory", "heap"],
     "Le ticket contient des indices de problème mémoire ou de saturation de ressources."),
    (["timeout", "slow", "latency", "performance", "hang"],
     "Le ticket évoque une dégradation de performance ou un blocage fonctionnel."),
    (["exception", "stacktrace", "traceback", "error", "null"],
     "Le ticket montre clairement un symptôme d'erreur technique ou une exception remontée."),
    (["feature", "request", "enhancement", "roadmap"],
     "Le ticket semble davantage lié à une évolution fonctionnelle ou à une demande de produit."),
]
CONTEXT_DEFAULT = "Le ticket nécessite une lecture attentive des détails techniques et du contexte métier."
ASSIGNMENT_BY_TYPE = {
    "bug": "Assigner à l'équipe de maintenance du module concerné.",
    "improvement": "Placer dans le backlog produit pour priorisation par le PO.",
    "new feature": "Transmettre au Product Owner pour évaluation roadmap.",
    "sub-task": "Rattacher la sous-tâche à son ticket parent et suivre l'avancement global.",
    "task": "Assigner à l'équipe technique en charge de l'opérationnel.",
    "test": "Orienter vers l'équipe QA pour couverture de test.",
    "documentation": "Confier à l'équipe documentation.",
}
ASSIGNMENT_DEFAULT = "Effectuer un triage manuel : le type d'incident est ambigu (catégorie 'Other')."
ACTION_BY_RESOLUTION = {
    "fixed": "Vérifier qu'un correctif ou un commit existe déjà et prévoir un test de non-régression.",
    "won't fix": "Documenter la justification puis fermer après validation du PO.",
    "wontfix": "Documenter la justification puis fermer après validation du PO.",
    "invalid": "Demander des précisions au rapporteur et confirmer la version concernée avant fermeture.",
    "duplicate": "Rechercher le ticket d'origine et fusionner les deux entrées si nécessaire.",
    "incomplete": "Demander les logs complets, les étapes de reproduction et le contexte exact.",
    "cannot reproduce": "Demander l'environnement, la version exacte et les détails de reproduction.",
    "not a problem": "Clarifier avec le rapporteur le comportement attendu et la cible fonctionnelle.",
}
ACTION_DEFAULT = "Examiner manuellement le ticket : la résolution prédite est incertaine."
STEPS_BY_TYPE = [
    (["bug", "task", "test"], [
        "Valider le symptôme principal et l'impact utilisateur ou système.",
        "Vérifier les logs, la stacktrace et les derniers changements liés au module.",
        "Définir un plan d'action court : reproduction, correctif, test ou escalade si besoin.",
    ]),
    (["new feature", "improvement"], [
        "Qualifier la demande et vérifier s'elle répond à un besoin métier réel.",
        "Identifier les contraintes techniques, les dépendances et le périmètre à couvrir.",
        "Préparer une proposition de priorisation ou d'implémentation pour le PO et l'équipe.",
    ]),
]
STEPS_DEFAULT = [
    "Rassembler les informations utiles autour du ticket et des échanges associés.",
    "Confirmer la bonne compréhension du besoin avant toute prise en charge.",
    "Définir le prochain pas opérationnel avec l'équipe concernée.",
]
URGENCY_BY_PRIORITY = [
    (["blocker", "critical"], "Priorité haute : traiter immédiatement et escalader si nécessaire."),
    (["major"], "À planifier dans le sprint en cours."),
]
URGENCY_DEFAULT = "Peut être placé dans le backlog, sans urgence particulière."
RECOMMENDATION_SOURCE = "Moteur de règles contextuel (NLP)"

# --- reference tickets shown when history has none: type -> (key, summary, resolution) ----
FALLBACK_REFERENCES = {
    "Bug": [
        ("SPARK-REF-BUG-1", "Memory leak in TaskSetManager during long-running jobs", "Fixed"),
        ("SPARK-REF-BUG-2", "NullPointerException thrown when reading empty Parquet file", "Fixed"),
        ("SPARK-REF-BUG-3", "Executor crashes with OutOfMemoryError under high shuffle load", "Fixed"),
    ],
    "Improvement": [
        ("SPARK-REF-IMP-1", "Improve performance of DataFrame groupBy aggregation", "Fixed"),
        ("SPARK-REF-IMP-2", "Reduce memory footprint of broadcast joins", "Fixed"),
        ("SPARK-REF-IMP-3", "Optimize shuffle partition handling for skewed data", "Fixed"),
    ],
    "New Feature": [
        ("SPARK-REF-NF-1", "Add support for new file format in DataSource API", "Fixed"),
        ("SPARK-REF-NF-2", "Expose configuration option for adaptive query execution", "Fixed"),
        ("SPARK-REF-NF-3", "Provide built-in function for array transformations", "Incomplete"),
    ],
    "Sub-task": [
        ("SPARK-REF-ST-1", "Sub-task: implement unit tests for the new optimizer rule", "Fixed"),
        ("SPARK-REF-ST-2", "Sub-task: update documentation for the parent feature", "Fixed"),
        ("SPARK-REF-ST-3", "Sub-task: refactor helper used by the parent ticket", "Fixed"),
    ],
    "Task": [
        ("SPARK-REF-TSK-1", "Upgrade dependency to the latest stable version", "Fixed"),
        ("SPARK-REF-TSK-2", "Clean up deprecated configuration keys", "Fixed"),
        ("SPARK-REF-TSK-3", "Migrate build scripts to the new tooling", "Fixed"),
    ],
}
FALLBACK_GENERIC = [
    ("SPARK-REF-GEN-1", "Investigate reported behaviour and gather reproduction steps", "Incomplete"),
    ("SPARK-REF-GEN-2", "Clarify expected behaviour with the reporter", "Not A Problem"),
    ("SPARK-REF-GEN-3", "Check whether the issue duplicates an existing ticket", "Duplicate"),
]

# --- nearest-neighbour vote --------------------------------------------------------------
NEIGHBOURS = 15
METADATA_BOOSTS = {"priority": 0.10, "status": 0.08, "reporter": 0.05}

# --- confidence bands: lower bound -> name -------------------------------------------------
CONFIDENCE_BANDS = [(0.65, "High"), (0.45, "Medium")]
CONFIDENCE_LOWEST = "Low"
