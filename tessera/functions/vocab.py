"""The vocabularies that decide results, in their given order. Data only."""

# Strings that mean a value is absent.
MISSING = (
    "", "n a", "na", "n/a", "none", "null", "nan", "unknown", "not available", "-", "--", "?", "no data",
    "n.a.",
)

# Text that is present but says nothing.
PLACEHOLDERS = (
    "na", "n a", "n/a", "n.a.", "nil", "none", "null", "nan", "unknown", "not known", "not available",
    "not applicable", "no data", "no name", "unnamed", "untitled", "unspecified", "missing", "empty", "-",
    "--", "---", "?", ".", "0", "00", "000", "test", "sample", "placeholder", "xxx", "tbd",
)

# Trailing words of legal names.
LEGAL = (
    "llc", "l l c", "lc", "inc", "incorporated", "corp", "corporation", "co", "company", "ltd", "limited",
    "lp", "llp", "plc", "pc", "pa", "gmbh", "ag", "bv", "nv", "sa", "srl", "spa", "pte", "pty", "shop",
    "store", "the", "and", "of", "group", "holdings", "enterprises", "ventures", "partners", "services",
    "service", "systems", "supply", "supplies", "solution", "solutions", "international", "worldwide",
    "global", "national", "usa", "us",
)

# Generic business words.
GENERIC = (
    "shop", "store", "group", "holdings", "enterprises", "ventures", "partners", "services", "service",
    "systems", "supply", "supplies", "solution", "solutions", "international", "worldwide", "global",
    "national", "company", "co",
)

# Marks of a second name; the part before the first counts.
SECOND_NAME = (
    "dba", "aka", "fka", "a k a", "d b a",
)

# Street words and their long form.
STREET = {
    "st": "street",
    "str": "street",
    "stree": "street",
    "ave": "avenue",
    "av": "avenue",
    "aven": "avenue",
    "blvd": "boulevard",
    "blv": "boulevard",
    "boul": "boulevard",
    "rd": "road",
    "dr": "drive",
    "drv": "drive",
    "ln": "lane",
    "ct": "court",
    "crt": "court",
    "pl": "place",
    "plz": "plaza",
    "sq": "square",
    "ter": "terrace",
    "terr": "terrace",
    "cir": "circle",
    "circ": "circle",
    "hwy": "highway",
    "highwy": "highway",
    "pkwy": "parkway",
    "pky": "parkway",
    "parky": "parkway",
    "expy": "expressway",
    "fwy": "freeway",
    "aly": "alley",
    "bnd": "bend",
    "bnds": "bends",
    "xing": "crossing",
    "hvn": "haven",
    "mnr": "manor",
    "mt": "mount",
    "ft": "fort",
    "vw": "view",
    "trl": "trail",
    "wy": "way",
}

STREET |= {x: x for x in list(STREET.values())}

# Directions and their short form.
DIRECTION = {
    "n": "n",
    "north": "n",
    "s": "s",
    "south": "s",
    "e": "e",
    "east": "e",
    "w": "w",
    "west": "w",
    "ne": "ne",
    "northeast": "ne",
    "nw": "nw",
    "northwest": "nw",
    "se": "se",
    "southeast": "se",
    "sw": "sw",
    "southwest": "sw",
}

# Words before a unit number.
UNITS = (
    "apt", "apartment", "ste", "suite", "unit", "rm", "room", "fl", "floor", "bldg", "building", "#", "no",
    "num", "lot", "dept", "trlr", "rte", "box", "po", "pobox",
)

# Further words that no locality has.
NOT_LOCAL = (
    "survey", "plot", "premises", "property", "godown", "warehouse", "building", "block", "flat", "shop",
    "office", "floor", "level",
)

# Words that open a landmark.
LANDMARKS = (
    "near", "opposite", "opp", "behind", "beside", "next", "adjacent", "close", "besides", "alongside",
    "infront", "before",
)

# Postal codes of US states.
STATES = {
    "alabama": "AL",
    "alaska": "AK",
    "arizona": "AZ",
    "arkansas": "AR",
    "california": "CA",
    "colorado": "CO",
    "connecticut": "CT",
    "delaware": "DE",
    "florida": "FL",
    "georgia": "GA",
    "hawaii": "HI",
    "idaho": "ID",
    "illinois": "IL",
    "indiana": "IN",
    "iowa": "IA",
    "kansas": "KS",
    "kentucky": "KY",
    "louisiana": "LA",
    "maine": "ME",
    "maryland": "MD",
    "massachusetts": "MA",
    "michigan": "MI",
    "minnesota": "MN",
    "mississippi": "MS",
    "missouri": "MO",
    "montana": "MT",
    "nebraska": "NE",
    "nevada": "NV",
    "new hampshire": "NH",
    "new jersey": "NJ",
    "new mexico": "NM",
    "new york": "NY",
    "north carolina": "NC",
    "north dakota": "ND",
    "ohio": "OH",
    "oklahoma": "OK",
    "oregon": "OR",
    "pennsylvania": "PA",
    "rhode island": "RI",
    "south carolina": "SC",
    "south dakota": "SD",
    "tennessee": "TN",
    "texas": "TX",
    "utah": "UT",
    "vermont": "VT",
    "virginia": "VA",
    "washington": "WA",
    "west virginia": "WV",
    "wisconsin": "WI",
    "wyoming": "WY",
    "district of columbia": "DC",
}

# Codes of Indian states and territories.
INDIA = {
    "andhra pradesh": "AP",
    "arunachal pradesh": "AR",
    "assam": "AS",
    "bihar": "BR",
    "chhattisgarh": "CG",
    "goa": "GA",
    "gujarat": "GJ",
    "haryana": "HR",
    "himachal pradesh": "HP",
    "jharkhand": "JH",
    "karnataka": "KA",
    "kerala": "KL",
    "madhya pradesh": "MP",
    "maharashtra": "MH",
    "manipur": "MN",
    "meghalaya": "ML",
    "mizoram": "MZ",
    "nagaland": "NL",
    "odisha": "OD",
    "orissa": "OD",
    "punjab": "PB",
    "rajasthan": "RJ",
    "sikkim": "SK",
    "tamil nadu": "TN",
    "telangana": "TG",
    "tripura": "TR",
    "uttar pradesh": "UP",
    "uttarakhand": "UK",
    "west bengal": "WB",
    "delhi": "DL",
    "puducherry": "PY",
    "pondicherry": "PY",
    "lakshadweep": "LD",
}

REGIONS = STATES | INDIA

# Business labels and the type they mean.
CATEGORIES = {
    "restaurant": "restaurant",
    "restaurants": "restaurant",
    "eating places": "restaurant",
    "food services": "restaurant",
    "cafe": "restaurant",
    "cafes": "restaurant",
    "coffee": "coffee",
    "coffee shop": "coffee",
    "coffeehouse": "coffee",
    "coffee and tea shops": "coffee",
    "bakery": "bakery",
    "bakeries": "bakery",
    "catering": "catering",
    "caterers": "catering",
    "auto": "auto",
    "auto repair": "auto",
    "automotive": "auto",
    "auto services": "auto",
    "auto repair shops": "auto",
    "mechanical": "auto",
    "car repair": "auto",
    "tire": "auto",
    "tires": "auto",
    "body shop": "auto",
    "bike": "bike",
    "bicycle": "bike",
    "bicycle dealers": "bike",
    "bike shops": "bike",
    "cycling": "bike",
    "hardware": "hardware",
    "hardware store": "hardware",
    "building supply": "hardware",
    "home improvement": "hardware",
    "plumbing": "plumbing",
    "plumber": "plumbing",
    "plumbers": "plumbing",
    "plumbing contractors": "plumbing",
    "electrical": "electrical",
    "electrician": "electrical",
    "electrical contractors": "electrical",
    "electric": "electric",
    "electricians": "electric",
    "construction": "construction",
    "contractor": "construction",
    "general contractor": "construction",
    "builders": "construction",
    "roofing": "roofing",
    "roofing contractors": "roofing",
    "roofer": "roofing",
    "siding": "siding",
    "siding contractors": "siding",
    "pool": "pool",
    "pool service": "pool",
    "pool and spa services": "pool",
    "landscaping": "landscaping",
    "lawn care": "landscaping",
    "landscaping services": "landscaping",
    "lawn maintenance": "landscaping",
    "gardener": "landscaping",
    "pest control": "landscaping",
    "exterminator": "landscaping",
    "locksmith": "landscaping",
    "moving": "moving",
    "moving company": "moving",
    "movers": "moving",
    "storage": "storage",
    "self storage": "storage",
    "storage units": "storage",
    "cleaning": "cleaning",
    "dry cleaner": "cleaning",
    "dry cleaners and laundry": "cleaning",
    "cleaners": "cleaning",
    "laundry": "cleaning",
    "legal": "legal",
    "law office": "legal",
    "legal services": "legal",
    "attorney": "legal",
    "law firm": "legal",
    "attorneys": "legal",
    "law firms": "legal",
    "accounting": "accounting",
    "accountant": "accounting",
    "accounting and tax services": "accounting",
    "bookkeeping": "accounting",
    "cpa": "accounting",
    "tax preparation": "accounting",
    "insurance": "insurance",
    "insurance agency": "insurance",
    "insurance agencies": "insurance",
    "realestate": "realestate",
    "real estate": "realestate",
    "realty": "realestate",
    "realtor": "realestate",
    "realtors": "realestate",
    "finance": "finance",
    "bank": "finance",
    "banking": "finance",
    "financial services": "finance",
    "printing": "printing",
    "print shop": "printing",
    "printing and copy centers": "printing",
    "sign shop": "printing",
    "travel": "travel",
    "travel agency": "travel",
    "tour": "travel",
    "photography": "photography",
    "photographer": "photography",
    "dental": "dental",
    "dentist": "dental",
    "dental services": "dental",
    "dentists": "dental",
    "orthodontist": "dental",
    "medical": "medical",
    "doctor": "medical",
    "physician": "medical",
    "clinic": "medical",
    "hospital": "medical",
    "chiropractor": "medical",
    "pharmacy": "pharmacy",
    "pharmacies": "pharmacy",
    "pharmacies and drug stores": "pharmacy",
    "drugstore": "pharmacy",
    "optometry": "optometry",
    "optician": "optometry",
    "opticians and ophthalmologists": "optometry",
    "fitness": "fitness",
    "gym": "fitness",
    "health club": "fitness",
    "fitness centers and gyms": "fitness",
    "yoga": "fitness",
    "pilates": "fitness",
    "hardware retail": "hardware",
    "furniture": "furniture",
    "furniture store": "furniture",
    "furniture stores": "furniture",
    "floral": "floral",
    "florist": "floral",
    "flower shop": "floral",
    "florists": "floral",
    "flowers": "floral",
    "retail": "retail",
    "clothing": "retail",
    "apparel": "retail",
    "boutique": "retail",
    "grocery": "grocery",
    "supermarket": "grocery",
    "food market": "grocery",
    "convenience store": "grocery",
    "liquor store": "grocery",
    "pet": "pet",
    "pet store": "pet",
    "pets": "pet",
    "pet stores": "pet",
    "pet supplies": "pet",
    "veterinarian": "pet",
    "vet": "pet",
    "animal hospital": "pet",
    "beauty": "beauty",
    "hair salon": "beauty",
    "beauty salon": "beauty",
    "beauty salons": "beauty",
    "barbershop": "beauty",
    "barber": "beauty",
    "barber shops": "beauty",
    "nail salon": "beauty",
    "personalcare": "personalcare",
    "tattoo": "personalcare",
    "massage": "personalcare",
    "day spa": "personalcare",
    "spa": "personalcare",
    "childcare": "childcare",
    "daycare": "childcare",
    "child care services": "childcare",
    "day care centers": "childcare",
    "hotel": "hotel",
    "hotels": "hotel",
    "motel": "hotel",
    "inn": "hotel",
}
