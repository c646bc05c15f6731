"""Closed lists, dictionaries, patterns and weights the results depend on.

Every table here is a FIXED VALUE: the published results are only comparable if
these words, codes and numbers stay exactly as they are. Order matters wherever
a comment says so. All of them are defaults; every operator takes its own
dictionary as an argument.
"""

from __future__ import annotations

# --------------------------------------------------------------- fixed values
# canonical field -> header spellings seen in published tables, in preference
# order (the first field to register a spelling keeps it).
HEADER_ALIASES: dict[str, list[str]] = {
    "project_code": [
        "smis code", "project code", "cod smis", "codsmis", "cod smis proiect",
        "cod smis cod proiect", "cod my smis", "cod mysmis", "cod proiect",
        "cod smis 2014", "numar contract", "cod apel",
    ],
    "beneficiary_name": [
        "beneficiary name", "beneficiary", "beneficiar", "denumire beneficiar",
        "nume beneficiar", "denumirea beneficiarului", "solicitant",
        "denumire solicitant",
    ],
    "beneficiary_cui": [
        "cui", "cui beneficiar", "cod fiscal", "cod unic de inregistrare", "cif",
        "cui cif",
    ],
    "project_title": [
        "project title", "titlu proiect", "denumire proiect", "titlul proiectului",
        "denumirea proiectului", "titlu", "denumire operatiune",
        "denumirea operatiunii",
    ],
    "project_summary": [
        "project summary", "rezumat", "obiectivul proiectului", "scopul operatiunii",
        "descriere proiect", "rezumatul proiectului", "sinteza proiectului",
    ],
    "start_date": [
        "project start date", "start date", "data inceput", "data de incepere",
        "data inceput proiect", "data semnarii contractului", "data de start",
    ],
    "end_date": [
        "project end date", "end date", "data sfarsit", "data de finalizare",
        "data finalizare", "data sfarsit proiect", "data de incheiere",
    ],
    "total_eligible_amount": [
        "total eligible value", "eligible value", "valoarea eligibila a proiectului",
        "valoare eligibila a proiectului", "valoare totala eligibila",
        "valoare eligibila totala", "cheltuiala eligibila totala",
        "valoare eligibila",
    ],
    "total_project_amount": [
        "total value of the project", "total project value", "total valoare proiect",
        "valoarea totala a proiectului", "valoare totala proiect", "valoare totala",
    ],
    "payments_amount": [
        "payments to beneficiaries", "plati catre beneficiari lei",
        "plati catre beneficiari", "plati efectuate", "valoare plati",
    ],
    "beneficiary_type": ["tip beneficiar", "tipul beneficiarului", "beneficiary type"],
    "eu_amount": [
        "eu funds", "eu contribution", "valoare ue", "contributie ue", "finantare ue",
        "valoare finantare ue", "contributia uniunii europene",
        "valoare nerambursabila ue", "fonduri ue",
    ],
    "cofinancing_rate": [
        "union co financing rate", "union cofinancing rate", "eu co financing rate",
        "co financing rate", "rata de cofinantare", "procent cofinantare",
        "rata cofinantare ue",
    ],
    "fund": ["fond", "fondul", "sursa de finantare"],
    "program": ["program", "program operational", "denumire program", "po"],
    "specific_objective": [
        "priority axis investment priority", "priority axis", "obiectiv specific",
        "os", "prioritate", "axa prioritara", "domeniu major de interventie",
    ],
    "intervention_code": [
        "categorie de interventie", "cod interventie", "tip interventie",
        "domeniu de interventie", "cod domeniu de interventie",
    ],
    "region": ["regiune", "regiunea", "regiune de dezvoltare", "region"],
    "county": ["judet", "judetul", "judet implementare", "county"],
    "locality": ["localitate", "localitatea", "uat", "oras", "comuna", "locality"],
    "project_status": [
        "stadiu", "stare proiect", "status", "stadiu implementare", "project status",
    ],
    "currency": ["moneda", "valuta"],
}

HEADER_SCAN_ROWS = 12
HEADER_MIN_FIELDS = 2
HEADER_CELL_MAX_CHARS = 90

# Company legal forms dropped from the end of a name.
LEGAL_FORMS = [
    "srl", "sa", "sca", "snc", "scs", "pfa", "ii", "if", "ong", "asociatia",
    "fundatia", "societatea",
]
SPELLED_LEGAL_FORMS = ["s r l", "s a"]
COMPANY_NOISE_TOKENS = ["sc", "s", "c"]

# Names with these words mark sums and footers.
TOTAL_ROW_WORDS = (
    r"(total|subtotal|contributi|cheltuieli|valoare|suma|fonduri|nr\.? crt)"
)
MONEY_FIELDS = [
    "total_eligible_amount", "total_project_amount", "eu_amount",
    "payments_amount", "cofinancing_rate",
]
DATE_FIELDS = ["start_date", "end_date"]

# county -> (two-letter code, development region)
COUNTIES: dict[str, tuple[str, str]] = {
    "Alba": ("AB", "Centru"),
    "Arad": ("AR", "Vest"),
    "Argeș": ("AG", "Sud-Muntenia"),
    "Bacău": ("BC", "Nord-Est"),
    "Bihor": ("BH", "Nord-Vest"),
    "Bistrița-Năsăud": ("BN", "Nord-Vest"),
    "Botoșani": ("BT", "Nord-Est"),
    "Brăila": ("BR", "Sud-Est"),
    "Brașov": ("BV", "Centru"),
    "București": ("B", "București-Ilfov"),
    "Buzău": ("BZ", "Sud-Est"),
    "Caraș-Severin": ("CS", "Vest"),
    "Călărași": ("CL", "Sud-Muntenia"),
    "Cluj": ("CJ", "Nord-Vest"),
    "Constanța": ("CT", "Sud-Est"),
    "Covasna": ("CV", "Centru"),
    "Dâmbovița": ("DB", "Sud-Muntenia"),
    "Dolj": ("DJ", "Sud-Vest Oltenia"),
    "Galați": ("GL", "Sud-Est"),
    "Giurgiu": ("GR", "Sud-Muntenia"),
    "Gorj": ("GJ", "Sud-Vest Oltenia"),
    "Harghita": ("HR", "Centru"),
    "Hunedoara": ("HD", "Vest"),
    "Ialomița": ("IL", "Sud-Muntenia"),
    "Iași": ("IS", "Nord-Est"),
    "Ilfov": ("IF", "București-Ilfov"),
    "Maramureș": ("MM", "Nord-Vest"),
    "Mehedinți": ("MH", "Sud-Vest Oltenia"),
    "Mureș": ("MS", "Centru"),
    "Neamț": ("NT", "Nord-Est"),
    "Olt": ("OT", "Sud-Vest Oltenia"),
    "Prahova": ("PH", "Sud-Muntenia"),
    "Sălaj": ("SJ", "Nord-Vest"),
    "Satu Mare": ("SM", "Nord-Vest"),
    "Sibiu": ("SB", "Centru"),
    "Suceava": ("SV", "Nord-Est"),
    "Teleorman": ("TR", "Sud-Muntenia"),
    "Timiș": ("TM", "Vest"),
    "Tulcea": ("TL", "Sud-Est"),
    "Vaslui": ("VS", "Nord-Est"),
    "Vâlcea": ("VL", "Sud-Vest Oltenia"),
    "Vrancea": ("VN", "Sud-Est"),
}
COUNTY_SPELLINGS = {
    "bistrita nasaud": "Bistrița-Năsăud",
    "bistrita-nasaud": "Bistrița-Năsăud",
    "caras severin": "Caraș-Severin",
    "caras-severin": "Caraș-Severin",
    "satu-mare": "Satu Mare",
    "municipiul bucuresti": "București",
    "muncipiul bucuresti": "București",
    "bucuresti ilfov": "București",
}
NATIONAL = "Național"
NATIONAL_MARKERS = ["nivel national", "national", "intreaga tara", "toate judetele"]
# region -> pattern on lower-case text without diacritics
REGION_PATTERNS = {
    "București-Ilfov": r"bucuresti[ -]ilfov",
    "Sud-Vest Oltenia": r"sud[ -]vest",
    "Nord-Vest": r"nord[ -]vest",
    "Nord-Est": r"nord[ -]est",
    "Sud-Est": r"sud[ -]est",
    "Sud-Muntenia": r"sud[ -]munten",
    "Centru": r"(?<![a-z])centru(?![a-z])",
    "Vest": r"(?<![a-z-])vest(?![a-z])",
}

# fragment of the plain status text -> status; the first rule that fits wins.
STATUS_RULES = [
    ("curs de reziliere", "În reziliere"),
    ("proces de reziliere", "În reziliere"),
    ("reziliat", "Reziliat"),
    ("incetat", "Reziliat"),
    ("revocat", "Reziliat"),
    ("nefinalizat", "Nefinalizat"),
    ("finalizat", "Finalizat"),
    ("implementare", "În implementare"),
    ("etapiza", "Etapizat"),
    ("nefunctional", "Nefuncțional"),
    ("suspenda", "Suspendat"),
    ("indicatori", "Indicatori la zero"),
]
STATUS_UNKNOWN = "Necunoscut"
# The statuses a filter offers, in display order.
STATUSES = [
    "Finalizat", "În implementare", "Etapizat", "Nefinalizat", "În reziliere",
    "Reziliat", "Suspendat", "Nefuncțional", "Indicatori la zero", "Necunoscut",
]

CALL_CLOSED = "Închis"
CALL_UPCOMING = "Urmează"
CALL_ACTIVE = "Activ"
CALL_UNKNOWN = "Necunoscut"

# Activity codes by bucket and digital intervention codes.
ACTIVITY_BUCKETS = {
    "software": ["5821", "5829", "6201", "6202", "6203", "6209", "6311", "6312"],
    "cdi": ["7211", "7219"],
    "adiacent": ["2611", "2620", "6110", "6120", "6190"],
}
DIGITAL_INTERVENTIONS = ["013", "016", "017", "018", "019", "020", "021", "036"]

# (keyword, label, weight); order decides evidence order and label ties.
KEYWORDS: list[tuple[str, str, float]] = [
    ("aplicatie software", "produs", 0.9),
    ("produs software", "produs", 0.9),
    ("platforma software", "produs", 0.9),
    ("dezvoltare software", "produs", 0.85),
    ("aplicatie mobila", "produs", 0.8),
    ("aplicatie web", "produs", 0.8),
    ("platforma online", "produs", 0.7),
    ("solutie informatica", "produs", 0.7),
    ("sistem informatic", "produs", 0.65),
    ("software", "produs", 0.6),
    ("saas", "produs", 0.8),
    ("api", "produs", 0.4),
    ("digitalizare", "digitalizare", 0.7),
    ("solutii digitale", "produs", 0.7),
    ("solutie digitala", "produs", 0.7),
    ("servicii publice digitale", "digitalizare", 0.8),
    ("servicii digitale", "digitalizare", 0.65),
    ("instrumente digitale", "digitalizare", 0.6),
    ("hub de inovare digitala", "digitalizare", 0.6),
    ("interoperabilitate", "digitalizare", 0.6),
    ("prelucrarea datelor", "cdi", 0.55),
    ("servicii aplicatii produse", "produs", 0.8),
    ("aplicatii", "produs", 0.5),
    ("platforme informatice", "produs", 0.8),
    ("tehnologii avansate", "cdi", 0.5),
    ("inovare digitala", "cdi", 0.6),
    ("transformare digitala", "digitalizare", 0.7),
    ("erp", "digitalizare", 0.75),
    ("crm", "digitalizare", 0.75),
    ("automatizare proces", "digitalizare", 0.6),
    ("arhivare electronica", "digitalizare", 0.6),
    ("semnatura electronica", "digitalizare", 0.6),
    ("e guvernare", "digitalizare", 0.7),
    ("servicii electronice", "digitalizare", 0.6),
    ("ghiseu unic", "digitalizare", 0.5),
    ("inteligenta artificiala", "cdi", 0.85),
    ("invatare automata", "cdi", 0.85),
    ("machine learning", "cdi", 0.85),
    ("big data", "cdi", 0.7),
    ("blockchain", "cdi", 0.7),
    ("internet of things", "cdi", 0.6),
    ("iot", "cdi", 0.5),
    ("algoritm", "cdi", 0.5),
    ("centru de date", "infrastructura", 0.4),
    ("cloud", "infrastructura", 0.45),
    ("infrastructura it", "infrastructura", 0.45),
    ("echipamente it", "infrastructura", 0.3),
    ("retea de calculatoare", "infrastructura", 0.3),
    ("banda larga", "infrastructura", 0.35),
]
# (keyword, penalty)
NEGATIVE_KEYWORDS: list[tuple[str, float]] = [
    ("reabilitare", 0.3),
    ("modernizare drum", 0.4),
    ("canalizare", 0.4),
    ("alimentare cu apa", 0.4),
    ("eficienta energetica", 0.25),
    ("constructie", 0.25),
]
WEIGHT_ACTIVITY = 0.45
RESEARCH_SHARE = 0.6
WEIGHT_INTERVENTION = 0.35
WEIGHT_TEXT = 0.75
WEIGHT_SECOND_HIT = 0.4
WEIGHT_MEANING = 0.6
WEIGHT_DOMAIN = 0.35
SOFTWARE_THRESHOLD = 0.5
LABEL_UNKNOWN = "necunoscut"
LABEL_DIGITAL = "digitalizare"
DIGITAL_DOMAIN = "Digitalizare"
STEM_MIN_CHARS = 5
STEM_MAX_ENDING = 4
EVIDENCE_MAX = 8
MEANING_FLOOR = 0.03
MEANING_CEILING = 0.30

# Month names of long dates.
MONTHS = {
    "ianuarie": 1, "februarie": 2, "martie": 3, "aprilie": 4, "mai": 5, "iunie": 6,
    "iulie": 7, "august": 8, "septembrie": 9, "octombrie": 10, "noiembrie": 11,
    "decembrie": 12,
}

# Labels on a call page.
PAGE_BUDGET = "Buget UE:"
PAGE_OPENS = "Data deschiderii:"
PAGE_CLOSES = "Data închiderii:"
PAGE_CALL_TYPE = "Tip Apel:"
PAGE_PROGRAMS = "Programe pentru care se aplică apelul"
PAGE_OBJECTIVE = "Obiectivul specific:"
PAGE_BENEFICIARIES = "Beneficiari eligibili"
PAGE_BENEFICIARIES_END = ["Criterii de eligibilitate", "Activități", "Buget"]
PAGE_DOMAINS = "Domenii Apel:"
PAGE_DOMAINS_END = ["Zone Geografice", "Share", "Calendar"]
PAGE_LIST_NOISE = ["domenii", "share"]
PAGE_NO_DEADLINE = "fără termen"
PAGE_PDF_LINK = r'href="(https?://[^"]+\.pdf)"'

# taxonomy -> field of a call
TAXONOMIES = {
    "beneficiar": "beneficiaries",
    "domeniu": "domains",
    "tip_apel": "call_types",
    "zona_geografica": "geo_areas",
}

# Program names found in file names: the portal's list and the archive's list.
PORTAL_PROGRAMS = (
    r"(?i)\b(poim|pocu|poca|poat|poad|por|poc|pcidif|pocidif|pndr|regio|podca)\b"
)
ARCHIVE_PROGRAMS = (
    r"(?i)\b(poim|pocu|poca|poat|poad|por|poc|pcidif|pocidif|regio|podca)\b"
)
UNKNOWN_PROGRAM = "necunoscut"
TABULAR_FORMATS = ["xlsx", "xls", "csv"]
LIST_FILE_NAMES = (
    r"(?i)(lista[_ -]?(proiectelor|contracte|contractate|beneficiar)"
    r"|proiecte[_ -]?contractate|contracte[_ -]?semnate"
    r"|contractate[_ -]?semnate[_ -]?finalizate)"
)
OTHER_FILE_NAMES = (
    r"(?i)(documente[_ .-]de[_ .-]interes|categorii[_ .-]documente|inscrieri"
    r"|dezbatere|selectie|contestatii|indicativa|respins|neeligibil|retras)"
)
LIST_FILE_SUFFIXES = [".pdf", ".xlsx", ".xls"]
MIN_PAYLOAD_BYTES = 4096
MIN_CODE_SHARE = 0.6
MIN_KEPT_SHARE = 0.66

# Outside links.
PROJECT_PAGE = "https://kohesio.ec.europa.eu/en/projects/"
PROJECT_PAGE_SOURCE = "kohesio"
PROJECT_SEARCH = "https://kohesio.ec.europa.eu/en/projects?keywords={query}&country=Q218"
FISCAL_PAGE = "https://mfinante.gov.ro/ro/web/site/info-fiscale?cui="
CALL_SITE = "https://oportunitati-ue.gov.ro"

# Columns whose gaps the other copies of a project close.
MERGED_FIELDS = [
    "eu_amount", "payments_amount", "total_project_amount", "total_eligible_amount",
    "beneficiary_cui", "project_summary", "intervention_code", "county", "region",
]
PAGE_SIZE = 25
# ----------------------------------------------------------- end fixed values
