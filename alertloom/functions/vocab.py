"""Code lists, curated names and wording that results must show exactly.

Everything here is data, kept in its natural order; what follows from it is derived at the end.
"""

# Fixed values.

ESCALATE = "escalate to analyst"
DISQUALIFY = "disqualify"

LABELS = {
    "DISP_MINOR_TYPO": "Single character typo or keyboard slip",
    "DISP_TOKEN_ORDER_SWAP": "Name tokens in different sequence",
    "DISP_MIDDLE_NAME_ABBREVIATED": "Middle name shortened to initial",
    "DISP_MIDDLE_INITIAL_EXPANDED": "Middle initial expanded to full name",
    "DISP_MIDDLE_NAME_OMITTED": "Middle name absent from one record",
    "DISP_TRANSLITERATION_VARIANT": "Same name, different transliteration standard",
    "DISP_DIACRITIC_STRIPPED": "Diacritics removed from name characters",
    "DISP_COMPOUND_NAME_RESTRUCTURED": "Hyphenated name split or merged",
    "DISP_EXACT_NAME_MATCH": "All name tokens match exactly, character for character",
    "DISP_SURNAME_CONFLICT": "Surnames are entirely different names",
    "DISP_MIDDLE_NAME_CONFLICT": "Middle names are irreconcilably different",
    "DISP_PHONETIC_SURNAME_DIVERGENCE": "Surnames phonetically shifted but distinct",
    "DISP_GIVEN_NAME_GENDER_VARIANT": "Given name differs only by gender inflection (e.g. Daniel/Daniela)",
}

FALSE_POSITIVE = [
    "DISP_SURNAME_CONFLICT", "DISP_MIDDLE_NAME_CONFLICT", "DISP_PHONETIC_SURNAME_DIVERGENCE",
    "DISP_GIVEN_NAME_GENDER_VARIANT",
]

OUTPUT = [
    "client_name", "hit_name", "matching_text", "disposition_code", "disposition_label", "thinking",
    "decision", "created_by",
]

ENTITY_WORDS = [
    "INC", "INCORPORATED", "LLC", "LTD", "LIMITED", "CORP", "CORPORATION", "CO", "COMPANY", "BANK",
    "FOUNDATION", "GROUP", "HOLDINGS", "ENTERPRISES", "SERVICES", "TRADING", "SA", "S.A.", "AG", "GMBH",
    "PLC", "B.V.", "BV", "MINISTRY", "DEPARTMENT", "AGENCY", "SOCIETY", "ASSOCIATION", "FUND", "TRUST",
    "COMMITTEE", "PARTY", "MOVEMENT", "BRIGADE", "FRONT", "ARMY",
]

WORLD_NAMES = {
    "East Asian (Chinese, Japanese, Korean)": [
        "Wei Zhang", "Ming Chen", "Jun Wang", "Xiao Liu", "Mei Huang", "Jin Zhao", "Hiroshi Tanaka",
        "Kenji Sato", "Daiki Suzuki", "Sakura Takahashi", "Yuto Watanabe", "Min-jun Kim", "Seo-jun Lee",
        "Ji-woo Park", "Ha-eun Choi", "Sun-woo Jeong", "Li Wei Chen", "Katsumi Takahashi", "Hyun-woo Shin",
    ],
    "South Asian (Indian, Pakistani, Bangladeshi)": [
        "Aarav Sharma", "Rohan Patel", "Priya Verma", "Ananya Singh", "Rajesh Kumar", "Vikram Rao",
        "Suresh Gupta", "Sunita Chatterjee", "Amit Banerjee", "Pooja Mukherjee", "Deepak Nair", "Tariq Khan",
        "Imran Ahmed", "Zainab Ali", "Farooq Hussain", "Harpreet Kaur", "Prashant Kulkarni",
        "Lakshmi Sundaram",
    ],
    "Middle Eastern & North African (MENA)": [
        "Tariq Al-Mansoor", "Omar Al-Fassi", "Ziad Al-Hashimi", "Khalid Al-Sabah", "Karim El-Baz",
        "Nour Haddad", "Layla Kabbaj", "Mariam Trabelsi", "Fatima Qasim", "Yasmin Mansour",
        "Mostafa Al-Masri", "Hamza Bin Rashid", "Ibrahim Al-Ghamdi", "Samiha Oglu", "Samir Al-Khouri",
        "Bilal Benali", "Habib Bourguiba",
    ],
    "African (West, East, Southern African)": [
        "Adebayo Okafor", "Olumide Mensah", "Chidiebere Mwangi", "Kwame Kamau", "Kofi Osei",
        "Babatunde Diallo", "Tendai Traore", "Amara Keita", "Zola Balogun", "Nnamdi Nwachukwu",
        "Sipho Dlamini", "Thabo Mokoena", "Farai Achebe", "Jengo Toure", "Kagiso Rabada", "Sekou Toure",
        "Wanjiku Njoroge",
    ],
    "Slavic & Eastern European": [
        "Dmitry Ivanov", "Alexei Petrov", "Sergei Smirnov", "Mikhail Volkov", "Nikolai Kuznetsov",
        "Ivan Popov", "Vladimir Sokolov", "Elena Morozova", "Svetlana Pavlova", "Tatiana Kozlova",
        "Jan Kowalski", "Luka Horvat", "Milos Stankovic", "Dragan Novak", "Bogdan Popescu",
        "Andrzej Wisniewski", "Zofia Dabrowska",
    ],
    "European (Germanic, Romance, Nordic)": [
        "Alexander Mueller", "Thomas Schmidt", "Lucas Schneider", "Pierre Dubois", "Matteo Rossi",
        "Marco Ferrari", "Julian Moreau", "Sophie Laurent", "Erik Lindqvist", "Lars Hansen",
        "Sebastian Weber", "Claire Fontaine", "Andrea Bianchi", "Frederik Nielsen", "Jean-Paul Belmondo",
        "Henrik Vanger", "Astrid Lindgren",
    ],
    "Hispanic & Latin American": [
        "Carlos Rodriguez", "Miguel Angel Hernandez", "Mateo Garcia", "Santiago Martinez", "Alejandro Lopez",
        "Sofia Gonzalez", "Valentina Perez", "Camila Sanchez", "Isabella Ramirez", "Javier Torres",
        "Diego Flores", "Lucia Gomez", "Andres Castillo", "Maria Elena Morales", "Gabriel Marquez",
        "Juana De La Cruz", "Federico Silva",
    ],
}

MIDDLE_NAMES = [
    "Alexander", "Robert", "James", "William", "David", "Edward", "Thomas", "Michael", "Joseph", "Charles",
    "Francis", "Raymond", "Anthony", "Patrick", "Lawrence", "Arthur", "George", "Pierre", "Jean", "Lucas",
    "Hassan", "Omar", "Ali", "Hussein", "Ibrahim", "Tariq", "Khalid", "Rashid", "Hamza", "Zayn", "Nour",
    "Karim", "Ziad", "Kumar", "Pratap", "Chandra", "Dev", "Mohan", "Nath", "Prakash", "Wei", "Ming", "Jun",
    "Chen", "Hiro", "Ken", "Min", "Woo", "Kwame", "Kofi", "Babatunde", "Chidi", "Amara", "Tendai",
]

SURNAMES = [
    "Smith", "Johnson", "Williams", "Brown", "Jones", "Miller", "Davis", "Rodriguez", "Hernandez", "Lopez",
    "Gonzalez", "Garcia", "Martinez", "Perez", "Wang", "Li", "Zhang", "Chen", "Liu", "Yang", "Huang", "Wu",
    "Zhou", "Tanaka", "Sato", "Suzuki", "Takahashi", "Watanabe", "Ito", "Nakamura", "Kim", "Lee", "Park",
    "Choi", "Jeong", "Kang", "Yoon", "Sharma", "Patel", "Verma", "Singh", "Kumar", "Rao", "Gupta",
    "Chatterjee", "Al-Mansoor", "Al-Hashimi", "Al-Sabah", "Al-Fassi", "Haddad", "Mansour", "Kabbaj", "Okafor",
    "Mensah", "Mwangi", "Kamau", "Osei", "Diallo", "Traore", "Balogun", "Ivanov", "Petrov", "Smirnov",
    "Volkov", "Kuznetsov", "Popov", "Kowalski", "Mueller", "Schmidt", "Schneider", "Fischer", "Weber",
    "Dubois", "Moreau", "Rossi", "Ferrari", "Bianchi", "Russo", "Hansen", "Lindqvist", "Nielsen",
]

LOCALES = [
    "en_US", "en_GB", "fr_FR", "de_DE", "es_ES", "it_IT", "pt_BR", "nl_NL", "sv_SE", "no_NO", "da_DK",
    "fi_FI", "pl_PL", "cs_CZ", "ro_RO", "hu_HU", "tr_TR", "id_ID",
]

PHONETIC = {
    "smith": ["Smyth", "Schmidt", "Smithe"],
    "johnson": ["Jansen", "Johnsen", "Jonson"],
    "williams": ["Williamson", "Willis", "Wilhelm"],
    "brown": ["Braun", "Browne", "Braune"],
    "davis": ["Davies", "Davison", "Davidson"],
    "miller": ["Mueller", "Muller", "Millar"],
    "wilson": ["Wilkinson", "Willson", "Wills"],
    "clark": ["Clarke", "Clerk", "Clarkson"],
    "white": ["Whyte", "Weitz", "Witt"],
    "harris": ["Harrison", "Harry", "Harries"],
    "martin": ["Martins", "Martinet", "Morton"],
    "thompson": ["Thomson", "Tompson", "Tompkins"],
    "mueller": ["Muller", "Moeller", "Miller"],
    "schmidt": ["Schmitt", "Schmid", "Smith"],
    "dubois": ["Du Bois", "Duboys", "Duboix"],
    "rossi": ["Rosi", "Russo", "De Rossi"],
    "hansen": ["Hanson", "Hanssen", "Jensen"],
    "mohammed": ["Muhammad", "Mohamed", "Mahmud", "Mohammad"],
    "muhammad": ["Mohammed", "Mohamed", "Mahmoud"],
    "ali": ["Aly", "Alley", "Alie"],
    "hassan": ["Hasan", "Hassane", "Hasen"],
    "hussein": ["Hussain", "Husein", "Husain"],
    "khan": ["Kahn", "Cahn", "Cann"],
    "yassin": ["Yasin", "Yacine", "Yassine"],
    "omar": ["Umar", "Omer", "Omarr"],
    "khalid": ["Khaled", "Calid", "Kalid"],
    "al-mansoor": ["Al-Mansur", "El-Mansoor", "Mansoor"],
    "al-fassi": ["Al-Fasi", "El-Fassi", "Fassi"],
    "haddad": ["Hadad", "Haddat", "Haddadi"],
    "zhang": ["Chang", "Tsang", "Zhan"],
    "wang": ["Wong", "Vang", "Huang"],
    "chen": ["Chan", "Chun", "Tan"],
    "kim": ["Gim", "Kym", "Keem"],
    "lee": ["Li", "Rhee", "Yi"],
    "park": ["Bak", "Pak", "Bark"],
    "tanaka": ["Tanacca", "Tanake"],
    "sato": ["Satou", "Satoh", "Satto"],
    "sharma": ["Sarma", "Sharmah", "Sharman"],
    "patel": ["Patell", "Patil", "Patle"],
    "singh": ["Sinh", "Sing", "Singhji"],
    "rao": ["Rau", "Row", "Raov"],
    "okafor": ["Okafore", "Ocafur", "Okafur"],
    "mwangi": ["Muangi", "Mwangee", "Mwangy"],
    "mensah": ["Mensa", "Menseh", "Menzah"],
    "dmitry": ["Dmitri", "Dmitriy", "Dmitrii"],
    "ivanov": ["Ivanoff", "Iwanow", "Ivanovs"],
    "petrov": ["Petroff", "Petrow", "Petrovic"],
    "rodriguez": ["Rodrigues", "Rodrigez", "Rodriquez"],
    "hernandez": ["Hernandes", "Fernandez", "Hernande"],
    "gonzalez": ["Gonzales", "Gonsalez", "Gonzalo"],
}

ROMANISED = {
    "muhammad": ["Mohammed", "Mohamed", "Mukhammad", "Mahomed", "Mehmet"],
    "mohammed": ["Muhammad", "Mohamed", "Mukhammad", "Mahomed"],
    "omar": ["Umar", "Omer", "Omarr", "Amr"],
    "hassan": ["Hasan", "Hassane", "Hasen", "Huseyn"],
    "hussein": ["Hussain", "Husein", "Husain", "Hossain"],
    "khalid": ["Khaled", "Kalid", "Calid", "Chalid"],
    "yassin": ["Yasin", "Yacine", "Yassine"],
    "ali": ["Aly", "Alie", "Aliy"],
    "tariq": ["Tarik", "Tareck", "Tarek"],
    "karim": ["Kareem", "Karime", "Karem"],
    "dmitry": ["Dmitri", "Dmitriy", "Dmitrii", "Dmytro"],
    "aleksei": ["Alexei", "Aleksey", "Alexey", "Aleksiy"],
    "mikhail": ["Michael", "Mikail", "Mihail"],
    "nikolai": ["Nikolay", "Nikolaos", "Nikola"],
    "yury": ["Yuri", "Iuri", "Juri", "Jurij"],
    "sergei": ["Sergey", "Serghei", "Serhiy"],
    "zhang": ["Chang", "Tsang", "Cheung"],
    "wang": ["Wong", "Vang", "Huang"],
    "chen": ["Chan", "Tan", "Chin"],
    "liu": ["Lau", "Lew", "Lo"],
    "li": ["Lee", "Ly", "Lei"],
    "priya": ["Pria", "Preya", "Priyah"],
    "rajesh": ["Rajish", "Rajech", "Rajec"],
}

TITLES = [
    "dr", "drs", "dott", "dra", "prof", "univ.prof", "ing", "mgr", "mgr.", "mvdr", "mr", "mrs", "ms", "miss",
    "sir", "madam", "madame", "mlle", "mme", "m", "mm", "sr", "sra", "srta", "don", "doña", "dona", "pan",
    "pani", "panna", "hr", "frau", "herr", "mevrouw", "de heer", "meneer", "senhor", "senhora", "signor",
    "signora", "señor", "señora", "shaykh", "sheik", "sheikh", "sayyid", "haji", "hajji", "av", "yrd. doç",
    "doç", "yrd", "doc", "bp", "ifj", "id", "fh", "v",
]

SUFFIXES = [
    "jr", "sr", "ii", "iii", "iv", "phd", "md", "esq", "mba", "msc", "bsc", "beng", "beng.", "ba", "ma",
    "llb", "llm", "dnp", "rn", "cfa", "cpa", "med", "m.farm", "m.phil", "mph", "dds", "dvm", "pharmd", "b.a",
    "m.a", "b.sc", "m.sc", "b.eng", "m.eng", "b.ed", "m.ed", "b.com", "m.com", "b.tech", "m.tech", "th.s",
]

NEIGHBOURS = {
    "a": "qwsz",
    "b": "vghn",
    "c": "xdfv",
    "d": "serfcx",
    "e": "wsdr",
    "f": "drtgvc",
    "g": "ftyhbv",
    "h": "gyujnb",
    "i": "ujko",
    "j": "hukmn",
    "k": "jiolm",
    "l": "kop",
    "m": "njk",
    "n": "bhjm",
    "o": "iklp",
    "p": "ol",
    "q": "wa",
    "r": "edft",
    "s": "wazxde",
    "t": "rfgy",
    "u": "yhji",
    "v": "cfgb",
    "w": "qase",
    "x": "zsdc",
    "y": "tghu",
    "z": "asx",
}

ACCENTED = [
    ("Müller", "Muller"), ("Möller", "Moller"), ("Schröder", "Schroder"), ("Günter", "Gunter"),
    ("Jürgen", "Jurgen"), ("Björn", "Bjorn"), ("Göran", "Goran"), ("Håkan", "Hakan"), ("Åsa", "Asa"),
    ("José", "Jose"), ("María", "Maria"), ("Álvarez", "Alvarez"), ("Gonzáles", "Gonzales"),
    ("Martínez", "Martinez"), ("García", "Garcia"), ("François", "Francois"), ("Hébert", "Hebert"),
    ("Renée", "Renee"), ("Çelik", "Celik"), ("Şahin", "Sahin"), ("Özdemir", "Ozdemir"),
    ("Ağaoğlu", "Agaoglu"), ("Žižek", "Zizek"), ("Šimić", "Simic"), ("Dvořák", "Dvorak"), ("Novák", "Novak"),
    ("Václav", "Vaclav"),
]

COMPOUND = [
    ("Jean-Paul", "Jean Paul"),
    ("Jean-Marie", "Jean Marie"),
    ("Jean-Pierre", "Jean Pierre"),
    ("Jean-Claude", "Jean Claude"),
    ("Anne-Marie", "Anne Marie"),
    ("Marie-Claire", "Marie Claire"),
    ("Al-Mansoor", "Al Mansoor"),
    ("Al-Fassi", "Al Fassi"),
    ("Al-Hashimi", "Al Hashimi"),
    ("Al-Masri", "Al Masri"),
    ("Abd-Al-Rahman", "Abd Al Rahman"),
    ("Ibn-Khalid", "Ibn Khalid"),
    ("Bin-Rashid", "Bin Rashid"),
    ("Bint-Ali", "Bint Ali"),
    ("Min-jun", "Min Jun"),
    ("Ha-eun", "Ha Eun"),
    ("Ji-woo", "Ji Woo"),
    ("Sun-woo", "Sun Woo"),
    ("Hyun-woo", "Hyun Woo"),
]

GENDERED = [
    ("Daniel", "Daniela"), ("Alexander", "Alexandra"), ("Michael", "Michaela"), ("Martin", "Martina"),
    ("Paul", "Paula"), ("Carl", "Carla"), ("Karl", "Karla"), ("Eric", "Erika"), ("Robert", "Roberta"),
    ("Peter", "Petra"), ("George", "Georgia"), ("Stephen", "Stephanie"), ("Joseph", "Josephine"),
    ("Adrian", "Adriana"), ("Julian", "Juliana"), ("Gabriel", "Gabriela"), ("Christian", "Christiana"),
    ("Victor", "Victoria"), ("Jan", "Jana"), ("Louis", "Louise"), ("Juan", "Juana"), ("José", "Josefa"),
    ("Luis", "Luisa"), ("Manuel", "Manuela"), ("Rafael", "Rafaela"), ("Alejandro", "Alejandra"),
    ("Carlos", "Carla"), ("Julio", "Julia"), ("Emilio", "Emilia"), ("Ramón", "Ramona"),
    ("Antonio", "Antonia"), ("Martín", "Martina"), ("Khalid", "Khalida"), ("Rashid", "Rashida"),
    ("Hamid", "Hamida"), ("Farid", "Farida"), ("Samir", "Samira"), ("Kamil", "Kamila"), ("Amin", "Amina"),
    ("Karim", "Karima"), ("Nabil", "Nabila"), ("Majid", "Majida"), ("Nadir", "Nadira"), ("Said", "Saida"),
    ("Adel", "Adela"), ("Munir", "Munira"), ("Salim", "Salima"), ("Halim", "Halima"), ("Ivan", "Ivana"),
    ("Pavel", "Pavla"), ("Stanislav", "Stanislava"), ("Vladislav", "Vladislava"), ("Miroslav", "Miroslava"),
    ("Jaroslav", "Jaroslava"), ("Bohdan", "Bohdana"), ("Alexandr", "Alexandra"), ("Zdenek", "Zdenka"),
    ("Vladimir", "Vladimira"), ("Jean", "Jeanne"), ("Marcel", "Marcelle"), ("Pascal", "Pascale"),
    ("Denis", "Denise"), ("François", "Françoise"), ("Paolo", "Paola"), ("Carlo", "Carla"),
    ("Franco", "Franca"), ("Roberto", "Roberta"), ("Alessandro", "Alessandra"), ("Emanuele", "Emanuela"),
    ("Gabriele", "Gabriella"), ("Daniele", "Daniela"), ("Valentino", "Valentina"), ("Amit", "Amita"),
    ("Anil", "Anila"),
]

WORDING = {
    "PRINCIPLE_TP_IDENTITY": [
        "Recording conventions differ across systems without changing legal identity.",
        "The same individual is routinely recorded differently across jurisdictions and databases.",
        "Name-level recording differences do not by themselves establish a different person.",
    ],
    "PRINCIPLE_FP_DISTINCT": [
        "Coincidental name overlap without full identity is the classic false positive pattern.",
        "A shared token alone never establishes the same natural person.",
        "Distinct identity markers outweigh any partial name overlap.",
    ],
    "PRINCIPLE_GENDER_MISMATCH": [
        "A mismatch in the recorded gender rules out the same natural person.",
        "Two personal names of different genders describe two different individuals.",
    ],
    "PRINCIPLE_ANALYST_REVIEW": [
        "Name identity alone is never sufficient for adverse action; an analyst must still confirm the secondary identifiers.",
        "An analyst must still confirm the secondary identifiers before the alert is closed.",
    ],
    "ORDER_MECHANISMS": [
        "family-name-first vs given-name-first convention",
        "jurisdiction-dependent token ordering",
    ],
    "MIDDLE_ABBREV_MECHANISMS": [
        "routine abbreviation of a middle name to its initial",
        "standard shortening of a middle name to an initial",
    ],
    "MIDDLE_EXPAND_MECHANISMS": [
        "routine expansion of a middle initial to the full name",
        "standard expansion of a recorded middle initial",
    ],
    "OMISSION_MECHANISMS": [
        "omission under form-field constraints during onboarding",
        "absence from one record's captured fields",
    ],
    "TRANSLITERATION_MECHANISMS": [
        "different international romanisation standards",
        "cross-standard transliteration conventions",
    ],
    "DIACRITIC_MECHANISMS": [
        "ASCII-only legacy system stripping",
        "Unicode normalisation differences across systems",
    ],
    "COMPOUND_MECHANISMS": [
        "hyphen split vs merged recording conventions",
        "inconsistent compound-name entry conventions",
    ],
    "BOUNDARY_MINOR_TYPO": [
        "The change is a clerical slip, not a curated gender inflection and not a transliteration variant.",
        "This reads as fast-typing noise, not a different personal name and not a romanisation difference.",
    ],
    "BOUNDARY_TOKEN_ORDER_SWAP": [
        "Every character is accounted for; only the sequence changed, so this is reordering rather than a typo or omission.",
        "No token is added, removed or altered — the sole phenomenon is token order.",
    ],
    "BOUNDARY_MIDDLE_ABBREVIATED": [
        "The initial is still present, so this is shortening rather than absence.",
        "The middle name is reduced to its initial, not omitted and not replaced.",
    ],
    "BOUNDARY_MIDDLE_EXPANDED": [
        "The full name expands the recorded initial rather than contradicting it.",
        "The recorded initial is spelled out, not swapped for a conflicting name.",
    ],
    "BOUNDARY_MIDDLE_OMITTED": [
        "Absence of a middle name is absence of data, not a conflicting identity marker.",
        "A missing middle token is non-information, not a discrepancy between two names.",
    ],
    "BOUNDARY_TRANSLITERATION": [
        "These are two romanisations of one name under different standards, not two distinct names.",
        "The variation follows documented transliteration conventions rather than a clerical error.",
    ],
    "BOUNDARY_DIACRITIC": [
        "The base letters are identical; only the marks were stripped, so this is not a typo.",
        "Character identity holds apart from diacritics — an encoding artefact, not a different name.",
    ],
    "BOUNDARY_COMPOUND": [
        "The token count changed because a hyphen was split or merged, not because tokens moved.",
        "Hyphen handling explains the restructuring; no name was added, dropped or reordered.",
    ],
    "BOUNDARY_EXACT_MATCH": [
        "There is no typographical slip, abbreviation, reordering, transliteration or diacritic variation to reconcile.",
        "No name-level discrepancy of any kind is available that could explain the alert away.",
    ],
    "BOUNDARY_SURNAME_CONFLICT": [
        "The two surnames have zero phonetic or etymological relation.",
        "The surnames are entirely different names with no shared root.",
    ],
    "BOUNDARY_MIDDLE_CONFLICT": [
        "These are two entirely separate personal names, not a shortening, slip or transliteration.",
        "The middle tokens are irreconcilably different names rather than recording variants.",
    ],
    "BOUNDARY_PHONETIC_DIVERGENCE": [
        "The surnames share sound but denote legally distinct family names — not a typo and not a transliteration pair.",
        "Phonetic resemblance does not make these the same surname; they are distinct legal names.",
    ],
    "BOUNDARY_GENDER_VARIANT": [
        "This is a different personal name of the opposite gender, not a recording variant of one name.",
        "The given-name difference marks a different individual, not a typo, abbreviation or transliteration.",
    ],
}

VARIANTS = {
    "DISP_MINOR_TYPO": 40,
    "DISP_TOKEN_ORDER_SWAP": 1,
    "DISP_MIDDLE_NAME_ABBREVIATED": 3,
    "DISP_MIDDLE_INITIAL_EXPANDED": len(MIDDLE_NAMES),
    "DISP_MIDDLE_NAME_OMITTED": 2,
    "DISP_TRANSLITERATION_VARIANT": 4,
    "DISP_DIACRITIC_STRIPPED": 2,
    "DISP_COMPOUND_NAME_RESTRUCTURED": 2,
    "DISP_EXACT_NAME_MATCH": 1,
    "DISP_SURNAME_CONFLICT": len(SURNAMES),
    "DISP_MIDDLE_NAME_CONFLICT": len(MIDDLE_NAMES),
    "DISP_PHONETIC_SURNAME_DIVERGENCE": 6,
    "DISP_GIVEN_NAME_GENDER_VARIANT": 1,
}
ANY_NAME = [
    "DISP_MINOR_TYPO", "DISP_TOKEN_ORDER_SWAP", "DISP_MIDDLE_NAME_OMITTED", "DISP_EXACT_NAME_MATCH",
    "DISP_SURNAME_CONFLICT", "DISP_MIDDLE_NAME_CONFLICT",
]
NAME_COLUMNS = ["name", "hitname", "client_name", "full_name", "individual_name"]
PARTICLES = ["bin", "ibn", "al", "el", "de", "del", "van", "von", "da"]
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# End of the fixed values.

#: Language of a locale -> the region whose built-in names it draws from; other languages are unknown.
REGION_OF = {
    lang: region
    for region, langs in zip(
        WORLD_NAMES,
        ("zh ja ko vi", "hi ur bn ta", "ar fa he tr", "sw yo ig zu ha", "ru uk pl cs sk ro hu bg hr sr sl", "en fr de it nl sv no nb da fi id", "es pt"),
        strict=True,
    )
    for lang in langs.split()
}

CODES = list(LABELS)
TRUE_POSITIVE = [c for c in CODES if c not in FALSE_POSITIVE]
DECISIONS = {c: DISQUALIFY if c in FALSE_POSITIVE else ESCALATE for c in CODES}


def fold(token: str) -> str:
    """Lower case without marks: compatibility decomposition, then ASCII only."""
    import unicodedata

    return unicodedata.normalize("NFKD", token).encode("ascii", "ignore").decode().lower()


def _first_wins(pairs):
    out = {}
    for key, value in pairs:
        out.setdefault(key, value)
    return out


COUNTERPART = _first_wins((key, b) for x, y in GENDERED for a, b in ((x, y), (y, x)) for key in (a.lower(), fold(a)))
GENDER = _first_wins((key, g) for x, y in GENDERED for a, g in ((x, "masculine"), (y, "feminine")) for key in (a.lower(), fold(a)))
HONORIFICS = sorted({t.replace(".", "").replace(",", "").strip().lower() for t in TITLES + SUFFIXES})
