"""Fixed values of the record rules: words, tables, patterns and defaults."""

# --- fixed values: legal-form and stop words left out of the core name
LEGAL_WORDS = [
    "inc", "incorporated", "llc", "llp", "lp", "ltd", "limited", "pvt", "private", "corp", "corporation", "co",
    "company", "pc", "plc", "pllc", "sarl", "sasu", "sas", "sci", "eurl", "sa", "gmbh", "opc", "ag", "the", "and",
    "of", "praivet", "piraivet", "elelp", "limitet",
]

# --- fixed values: address abbreviations
ABBREVIATIONS = {
    "st": "street", "str": "street", "ave": "avenue", "av": "avenue", "rd": "road", "dr": "drive",
    "blvd": "boulevard", "bd": "boulevard", "ln": "lane", "ct": "court", "cir": "circle", "hwy": "highway",
    "pkwy": "parkway", "pl": "place", "sq": "square", "ter": "terrace", "trl": "trail", "expy": "expressway",
    "n": "north", "s": "south", "e": "east", "w": "west", "ne": "northeast", "nw": "northwest",
    "se": "southeast", "sw": "southwest", "opp": "opposite", "nr": "near", "flr": "floor", "fl": "floor",
    "mt": "mount", "ft": "fort",
}

# --- fixed values: address words that vary between sources
ADDRESS_NOISE = [
    "no", "nr", "unit", "apartment", "apt", "ste", "suite", "bldg", "building", "flat", "door", "plot", "hno",
    "city", "of", "village", "town", "region", "the",
]

# --- fixed values: US states and the federal district
US_STATES = {
    "AL": "alabama", "AK": "alaska", "AZ": "arizona", "AR": "arkansas", "CA": "california", "CO": "colorado",
    "CT": "connecticut", "DE": "delaware", "FL": "florida", "GA": "georgia", "HI": "hawaii", "ID": "idaho",
    "IL": "illinois", "IN": "indiana", "IA": "iowa", "KS": "kansas", "KY": "kentucky", "LA": "louisiana",
    "ME": "maine", "MD": "maryland", "MA": "massachusetts", "MI": "michigan", "MN": "minnesota",
    "MS": "mississippi", "MO": "missouri", "MT": "montana", "NE": "nebraska", "NV": "nevada",
    "NH": "new hampshire", "NJ": "new jersey", "NM": "new mexico", "NY": "new york", "NC": "north carolina",
    "ND": "north dakota", "OH": "ohio", "OK": "oklahoma", "OR": "oregon", "PA": "pennsylvania",
    "RI": "rhode island", "SC": "south carolina", "SD": "south dakota", "TN": "tennessee", "TX": "texas",
    "UT": "utah", "VT": "vermont", "VA": "virginia", "WA": "washington", "WV": "west virginia",
    "WI": "wisconsin", "WY": "wyoming", "DC": "district of columbia",
}

# --- fixed values: country aliases after cleaning
COUNTRY_ALIASES = {
    "usa": "us", "u s": "us", "u s a": "us", "united states": "us", "united states of america": "us",
    "america": "us", "u k": "uk", "united kingdom": "uk", "great britain": "uk", "gb": "uk",
}

# --- fixed values: romanisation of Devanagari, the layout all Indic blocks share
VOWELS = {
    "अ": "a", "आ": "a", "इ": "i", "ई": "i", "उ": "u", "ऊ": "u", "ऋ": "ri", "ऌ": "li", "ऍ": "e", "ऎ": "e",
    "ए": "e", "ऐ": "ai", "ऑ": "o", "ऒ": "o", "ओ": "o", "औ": "au",
}
CONSONANTS = {
    "क": "k", "ख": "kh", "ग": "g", "घ": "gh", "ङ": "n", "च": "ch", "छ": "chh", "ज": "j", "झ": "jh", "ञ": "n",
    "ट": "t", "ठ": "th", "ड": "d", "ढ": "dh", "ण": "n", "त": "t", "थ": "th", "द": "d", "ध": "dh", "न": "n",
    "ऩ": "n", "प": "p", "फ": "ph", "ब": "b", "भ": "bh", "म": "m", "य": "y", "र": "r", "ऱ": "r", "ल": "l",
    "ळ": "l", "ऴ": "l", "व": "v", "श": "sh", "ष": "sh", "स": "s", "ह": "h",
}
MATRAS = {
    "ा": "a", "ि": "i", "ी": "i", "ु": "u", "ू": "u", "ृ": "ri", "ॅ": "e", "ॆ": "e", "े": "e", "ै": "ai",
    "ॉ": "o", "ॊ": "o", "ो": "o", "ौ": "au",
}
SIGNS = {"ं": "n", "ँ": "n", "ः": "h"}
HALANT = "्"
INDIC_FIRST, INDIC_LAST, INDIC_BLOCK = 0x0900, 0x0D7F, 0x80

# --- fixed values: Latin letters without a decomposition, lower case only
LATIN_SPECIALS = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ł": "l"}

# --- fixed values: patterns (Java and RE2 read them alike)
DOMAIN = r"(?:https?://)?(?:www\.)?([a-z0-9\-]+)\.(?:com|net|org|in|co|fr|io|biz|info)(?:\.[a-z]{2})?\b"
ORDINAL = r"\b(\d+)(?:st|nd|rd|th)\b"
SPACES = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
PUNCTUATION = r"[^\p{L}\p{N}_\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

# --- fixed values: defaults of blocking, training and decisions
TOP_K = {"name_char": 15, "name_word": 10, "name_squash": 8, "addr_char": 10, "combined": 15}
MIN_SIM = {"name_char": 0.15, "name_word": 0.15, "name_squash": 0.30, "addr_char": 0.30, "combined": 0.20}
NAME_SHARE, ADDRESS_SHARE = 0.6, 0.4
VALIDATION_FRACTION, SEED, F_BETA = 0.20, 42, 0.5
THRESHOLDS = [round(0.05 + 0.01 * k, 2) for k in range(91)]
BASELINE = {"precision": 0.8571, "recall": 0.5, "f0_5": 0.75, "threshold": 0.77}
