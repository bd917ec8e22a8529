"""Default reference lists.

Fixed values: results depend on them verbatim, including oddities such as ``comint`` and ``svcsst``.
Every job takes its lists as arguments, so these are only defaults.
"""

# Tokens dropped from every name.
STOP_TOKENS = [
    "0", "-", "1st", "and", "associates", "business", "care", "co", "company",
    "global", "group", "health", "tv", "isd", "ins", "uni", "dist", "mar", "comm", "comint",
    "limited", "llp", "lt", "ltd", "inc", "llc", "servi", "chemic", "scho", "securi",
    "of", "partners", "plc", "service", "services", "corp", "schoo", "svcsst",
    "systems", "system", "the", "trust", "store", "office", "com", "parts",
    "security", "na", "unkn", "unk", "unkown", "unkwn", "unknown", "none", "industries",
    "lighting", "television", "goods", "companies", "enterprises", "bank", "corporation",
    "worldwide", "district", "distri", "md", "public", "center", "shop", "ri", "s", "g", "ag",
    "joint", "1040", "2013joint", "2012", "2013", "2014", "2015", "2016", "2017", "2018", "2019",
    "00", "000", "0000", "00000", "000000", "0000000", "00000000", "000000000", "0000000000",
    "emp", "svcs",
]

# Whole cleaned name -> canonical name.
NAME_ALIASES = {
    "amex": "american express",
    "dominos": "dominos pizza",
    "ey": "ernest young",
    "j p morgan": "jp morgan",
    "j p morgan chase": "jp morgan",
    "jpmorgan": "jp morgan",
    "jpmorgan chase": "jp morgan",
    "pwc": "pricewaterhouse",
    "royal bank of scotland": "rbs",
    "self": "self employed",
    "myself": "self employed",
    "usaf": "us air force",
    "army": "us army",
    "air force": "us air force",
    "military": "military",
    "navy": "us navy",
    "united states air force": "us air force",
    "united states navy": "us navy",
    "united states army": "us army",
    "united states military": "us military",
    "alcatellucent": "alcatel lucent",
    "self emp": "self employed",
    "selfemployed": "self employed",
    "ret": "retired",
    "flash unknown": "",
    "not provided": "",
    "wal mart": "walmart",
    "wellsfargo": "wells fargo",
    "wholefoods": "whole foods",
    "a t  t": "att",
    "a t t": "att",
    "a t and t": "att",
    "at t": "att",
    "at t mobility": "att mobility",
    "chase manhattan": "chase",
    "chase manhatt": "chase",
    "self employeed": "self employed",
    "abbot": "abbott",
    "abercrombie": "abercrombie fitch",
    "accountemps": "accoun temps",
    "advanta": "advantage",
    "amazon.com": "amazon",
    "amazoncom": "amazon",
    "america merrill": "america merrill lynch",
    "amerisourcebergen": "amerisource bergen",
    "andersen": "anderson",
    "andersen windows": "anderson windows",
    "architectural": "architect",
    "artist": "arts",
    "assoc": "associate",
    "astrazeneca": "astra zeneca",
    "avisbudget": "avis budget",
    "barclay": "barclays",
    "barnes nobles": "barnes noble",
    "bd ed": "bd education",
    "beachbody": "beach body",
    "bear sterns": "bear stearns",
    "bearingpoint": "bearing point",
    "benefit": "benefits",
    "benefis": "benefits",
    "berkley": "berkeley",
    "bernards": "bernard",
    "bershire hathaway": "berkshire hathaway",
    "bestbuy": "best buy",
    "housewife": "home maker",
    "broward sheriff": "broward sheriffs",
    "byu idaho": "byuidaho",
    "charles schwabb": "charles schwab",
    "core logic": "corelogic",
    "corner stone": "corner stone",
    "country wide": "countrywide",
    "cracker barrell": "cracker barrel",
    "retirement": "retired",
}

# Fixed value: the one alias only the sample-data variant of the cleaning rules knows.
SAMPLE_NAME_ALIASES = {**NAME_ALIASES, "albertson": "albertsons"}

# Whole name spelt with numbers -> canonical name (case-sensitive).
NUMBER_ALIASES = {
    "seveneleven": "7 11",
    "seven eleven": "7 11",
    "seven11": "7 11",
    "7eleven": "7 11",
    "7 eleven": "7 11",
    "seven 11": "7 11",
    "711": "7 11",
    "threem": "3m",
    "three m": "3m",
    "3 m": "3m",
}

# Token abbreviation -> expansion.
TOKEN_EXPANSIONS = {
    "lab": "laboratories",
    "labs": "laboratories",
    "hos": "hospital",
    "hosp": "hospital",
    "hospit": "hospital",
    "universit": "university",
    "univ": "university",
    "univer": "university",
    "adminis": "administration",
    "administ": "administration",
    "admin": "administration",
    "adm": "administration",
    "market": "marketing",
    "marketin": "marketing",
    "expr": "express",
    "expres": "express",
    "processi": "processing",
    "fl": "florida",
    "hotel": "hotels",
    "ny": "new york",
    "nyc": "new york",
    "denv": "denver",
    "la": "los angeles",
    "lax": "los angeles",
    "seven": "7",
    "hr": "hour",
    "24hr": "24 hour",
    "sf": "san francisco",
    "medic": "medicine",
    "medicin": "medicine",
    "builders": "builder",
    "manageme": "management",
    "catapillar": "caterpillar",
    "catepillar": "caterpillar",
    "agi1040": "agi",
    "chemical": "chemicals",
    "zimmermann": "zimmerman",
}
