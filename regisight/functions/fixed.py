"""Codes, thresholds, bands and patterns that define the results."""

from datetime import date

# --- fixed values: thresholds -------------------------------------------------
MIN_CELL = 10                 # cells below are not published
MIN_SCOPE = 100               # a report needs at least this many subjects
MIN_BASE = 20                 # smallest base of an empirical transition
CONFLICT_SHARE = 0.9          # empirical target overrides the crosswalk from here
AUTO_LINK_CERTAINTY = 0.8     # division certainty for an automatic link
MISSING_LIMIT = 0.20          # snapshot quality gate
UNRELIABLE_SHARE = 25.0       # "only to section" in percent of the industry
FINDING_MIN = 0.03            # relative difference that counts as a finding
TERRITORY_EFFECT_SHARE = 0.5  # others must move by this part of the industry's change
STRUCTURE_MIN_SHARE = 5.0     # structure items below on both sides are left out
PUBLISHED_GAP = 0.10          # own count vs published count
MODEL_TOLERANCE_PCT = 1.0
RATES_FROM_YEAR = 2023
SHOWN_YEARS = 5

# --- fixed values: dates ------------------------------------------------------
START_2025 = date(2025, 1, 1)
END_DUAL_CODING = date(2028, 12, 31)

# --- fixed values: reasons and statuses as stored -----------------------------
REASON_CLOSED = "zánik subjektu"
REASON_DROPPED = "zdroj kód už neuvádí"
REASON_END_2008 = "konec dvojího kódování"
OFFICIAL, DERIVED, DERIVED_UNSURE = "RES", "odvozeno", "odvozeno, nejisté"
AMBIGUOUS = "nejednoznacne"
MAIN, SECONDARY = "hlavni", "vedlejsi"

# --- fixed values: natural-person legal forms ---------------------------------
NATURAL_FORMS = ("101", "102", "103", "104", "105", "106", "107", "108", "424", "425")

# --- fixed values: employee-size codes ----------------------------------------
SIZE_UNKNOWN = "000"
SIZE_CLASSES = ("0-9", "10-19", "20-49", "50-249", "GE250")
SIZE_CODE_TO_CLASS = {
    "110": "0-9", "120": "0-9", "130": "0-9", "210": "10-19", "220": "20-49", "230": "20-49",
    "240": "50-249", "310": "50-249", "320": "50-249",
}
SIZE_CODES_250 = ("330", "340", "410", "420", "430", "440", "450", "460", "470", "510")
SIZE_BANDS = (
    ("110", ("110",)),
    ("1-9", ("120", "130")),
    ("10-49", ("210", "220", "230")),
    ("50-249", ("240", "310", "320")),
    ("250+", SIZE_CODES_250),
    ("000", ("000",)),
)

# --- fixed values: age bands in years, half-open ------------------------------
AGE_BANDS = (
    (0, 3, "0-2"), (3, 6, "3-5"), (6, 11, "6-10"), (11, 21, "11-20"), (21, 31, "21-30"), (31, None, "31+"),
)

# --- fixed values: pseudo-codes of the register -------------------------------
PSEUDO_CODES = (("X", 1, None), ("04", 2, "X"), ("Y", 1, None), ("00", 2, "Y"))
PSEUDO_SECTIONS = ("X", "Y")
UNDETERMINED = "00"

# --- fixed values: currencies and types of amounts ----------------------------
MONEY_TYPES = {"KORUNY": "CZK", "EURA": "EUR"}

# --- fixed values: section 2025 -> (A*10 group, section of Rev. 2) ------------
SECTION_TO_A10 = {
    "A": ("A", "A"), "B": ("B-E", "B"), "C": ("C", "C"), "D": ("B-E", "D"), "E": ("B-E", "E"), "F": ("F", "F"),
    "G": ("G-I", "G"), "H": ("G-I", "H"), "I": ("G-I", "I"), "J": ("J", "J"), "K": ("J", "J"), "L": ("K", "K"),
    "M": ("L", "L"), "N": ("M_N", "M"), "O": ("M_N", "N"), "P": ("O-Q", "O"), "Q": ("O-Q", "P"), "R": ("O-Q", "Q"),
    "S": ("R-U", "R"), "T": ("R-U", "S"), "U": ("R-U", "T"), "V": ("R-U", "U"),
}

# --- fixed values: columns of the two snapshot files and of their dates -------
SUBJECT_COLUMNS = (
    "ICO", "OKRESLAU", "DDATVZN", "DDATZAN", "ZPZAN", "DDATPAKT", "FORMA", "ROSFORMA", "KATPO", "NACE", "NACE2025",
    "ICZUJ", "FIRMA", "CISS2010", "KODADM", "TEXTADR", "PSC", "OBEC_TEXT", "COBCE_TEXT", "ULICE_TEXT", "TYPCDOM",
    "CDOM", "COR", "DATPLAT", "PRIZNAK",
)
SUBJECT_DATES = ("DDATVZN", "DDATZAN", "DDATPAKT", "DATPLAT")
ACTIVITY_COLUMNS = ("ICO", "ZDRUD", "KODCIS", "HODN", "DATPLAT", "DDATPAKT", "PRIZNAK")
ACTIVITY_DATES = ("DATPLAT", "DDATPAKT")

# --- fixed values: kinds of findings, their order and id prefix ---------------
FINDING_KINDS = (
    ("odchylka_od_cr", "OD"), ("zmena_trendu", "TR"), ("rozdily_uvnitr_uzemi", "UZ"), ("aktivita_oboru", "AK"),
    ("divergence_poradi", "PO"), ("mzdy_zamestnanost", "MZ"), ("ekonomika", "EK"),
)
COUNT_TYPE = "pocet"
DERIVED_TYPES = ("podil", "index", "poradi", "prumer")

# --- fixed values: vocabulary and number patterns -----------------------------
BANNED_STEM = r"(?i)fir(?:m|em)|aktivn"
ALLOWED_AFTER_AKTIVN = r"\s+podnik"
PAGE_MARK = r"(?i)strana\s+\d+\s+z\s+\d+"
TABLE_REFERENCE = r"(?i)\b(?:tab\.|tabulk[ay]|graf[uy]?)\s+\d+\b"
TYPESET_NUMBER = r"\d+(?:[\u202f\u00a0]\d{3})*(?:[,.]\d+)?"
SPACED_NUMBER = r"\d{1,3}(?: \d{3})+(?:[,.]\d+)?"
