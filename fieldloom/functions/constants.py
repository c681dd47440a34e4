"""Fixed values of the domain. They are stated as they are; the code only looks them up."""

# Event codes kept at ingest.
EVENT_CODES = [
    2, 7, 8, 10, 11, 14, 15, 16, 17, 18, 19, 20, 22, 42, 43, 46, 47, 48, 56, 57, 74, 112, 121, 141, 162, 163, 171, 172, 173,
    70, 73, 74, 75,
    21, 22,
    30, 31, 32, 33, 34, 35, 36, 37, 38,
    100, 101, 102, 104,
    71, 72, 122,
]
# Event codes taken as noise among scraped articles.
NOISE_CODES = [10, 20, 30, 31, 32, 33, 34, 42, 43, 46]
# Country codes of the feeds (FIPS) and their ISO codes, in the same order.
FIPS = ["UV", "BY", "CG", "CM", "ET", "GV", "KE", "LI", "MA", "ML", "MR", "MI", "MZ", "NG", "NI", "SU", "SL", "SO", "OD", "CD", "UG", "YM", "ZA", "ZI", "CT"]
ISO = ["BF", "BI", "CG", "CM", "ET", "GN", "KE", "LR", "MG", "ML", "MR", "MW", "MZ", "NG", "NE", "SD", "SL", "SO", "SS", "CD", "UG", "YE", "ZM", "ZW", "CF"]
FIPS_TO_ISO = dict(zip(FIPS, ISO))
FIRST_YEAR, LAST_YEAR = 2016, 2024
VALID_SCORES = [1, 2, 3, 4, 5]

# Buckets of counted things; an entry goes to the first bucket with a matching keyword.
COUNT_BUCKETS = {
    "n_killed": ["kill", "killed", "dead", "death", "fatal", "murder", "casualty"],
    "n_injured": ["injur", "wound", "hurt", "hospital", "casualty"],
    "n_displaced": ["displac", "refugee", "evacuat", "flee", "relocat"],
    "n_missing": ["missing", "unaccounted", "kidnap", "abduct", "lost"],
    "usd_aid": ["aid", "relief", "assist", "donat", "support", "fund"],
    "n_food_related": ["food", "hunger", "famine", "malnutrit", "nutrition", "feeding"],
    "n_water_related": ["water", "drought", "thirst", "hydration"],
    "n_price_related": ["price", "inflation", "cost", "expens", "afford"],
    "n_market_related": ["market", "trade", "commerce", "supply", "demand", "import", "export", "commodity"],
    "n_conflict_related": ["conflict", "war", "battle", "combat", "clash", "violence", "attack", "raid", "uprising"],
    "n_disease_related": ["disease", "illness", "epidemic", "pandemic", "virus", "infection", "outbreak", "health"],
    "n_weather_related": ["weather", "storm", "flood", "climate", "cyclone", "rain", "heatwave", "cold wave", "typhoon", "hurricane", "tornado", "hail"],
    "n_policy_related": ["policy", "law", "regulat", "government", "legislat", "ban", "rule", "ordinance", "directive"],
}

# Categories of food-security words; of alternatives at one place the first listed matches.
WORD_CATEGORIES = {
    "fatalities": ["killed", "dead", "death", "deaths", "fatalities", "casualties", "life", "lost", "loss", "massacred", "loss of life", "lost their lives", "body discover", "tragically"],
    "displaced": ["displaced", "displacement", "fled", "evacuated", "refugees", "flee", "uprooted", "seek refuge", "leave", "relocation", "relocated", "relocate"],
    "detained": ["detained", "arrested", "imprisoned", "incarcerated", "held in custody", "held"],
    "injured": ["injured", "wounded", "hurt"],
    "sexual_violence": ["rape", "raped", "sexual violence", "sexual assault", "sexually assaulted", "sexual harassment"],
    "torture": ["torture", "tortured"],
    "economic_shocks": ["economic shock", "economic shocks", "financial crisis", "market collapse", "recession", "depression"],
    "agriculture": ["agriculture", "agricultural", "farming", "crop", "harvest", "livestock", "agrarian"],
    "weather": ["weather", "drought", "flood", "flooding", "storm", "rainfall", "extreme weather", "heatwave", "cold snap", "hurricane", "cyclone", "typhoon", "wildfire"],
    "food_insecurity": ["food insecurity", "food shortage", "malnutrition", "starvation", "undernourished", "lack of food", "food crisis"],
}
# Categories whose numbers are read from sentences, and words that make a number a time.
NUMBER_CATEGORIES = ["fatalities", "displaced", "detained", "injured", "sexual_violence", "torture"]
TIME_UNITS = ["hour", "hours", "minute", "minutes", "second", "seconds", "day", "days", "week", "weeks", "month", "months", "year", "years"]
# Ceilings of counts per article.
COUNT_CAPS = {"fatalities": 50, "injured": 100, "displaced": 500, "detained": 50, "sexual_violence": 10, "torture": 10}
# Right-closed bins of article counts and their labels.
ARTICLE_BINS = [(0, "0"), (5, "1-5"), (10, "6-10"), (20, "11-20"), (50, "21-50"), (None, "50+")]

# Terms of which a crisis article holds one, anywhere in a word (patterns), for events and for records.
CRISIS_TERMS_EVENTS = [
    "famine", "hunger", "malnutrition", "food", "nutrition", "crop", "harvest", "yield", "farmer", "agricultur", "drought", "flood", "rainfall", "storm", "cyclone",
    "heatwave", "disaster", "aid", "relief", "refugee", "displaced", "idp", "conflict", "war", "violence", "attack", "protest", "unrest", "livelihood", "poverty",
    "shortage", "inflation", "market", "commodity", "price", "food security", "early warning", "ipc", "wfp", "unicef", "ocha", "ngo",
]
CRISIS_TERMS_RECORDS = [
    "famine", "hunger", "malnutrition", "undernourish", "food\\s+crisis", "food\\s+security", "crop", "harvest", "yield", "farmer", "agricultur", "seed", "irrigat",
    "fertiliz", "pest", "livestock", "drought", "flood", "rainfall", "storm", "cyclone", "heatwave", "disaster", "aid", "relief", "humanitarian", "refugee", "displaced",
    "idp", "conflict", "violence", "clash", "attack", "insurgent", "militia", "war", "unrest", "protest",
]

# Words for numbers, and those of them that multiply.
NUMBER_WORDS = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10,
    "eleven": 11, "twelve": 12, "thirteen": 13, "fourteen": 14, "fifteen": 15, "sixteen": 16, "seventeen": 17, "eighteen": 18, "nineteen": 19,
    "twenty": 20, "thirty": 30, "forty": 40, "fifty": 50, "sixty": 60, "seventy": 70, "eighty": 80, "ninety": 90,
    "hundred": 100, "thousand": 1000, "million": 1_000_000,
}
MULTIPLIERS = [100, 1000, 1_000_000]

# Demonyms and the country each stands for; they match inside words too.
DEMONYMS = {
    "algerian": "algeria", "egyptian": "egypt", "libyan": "libya", "moroccan": "morocco", "tunisian": "tunisia", "sudanese": "sudan", "south sudanese": "south sudan",
    "beninese": "benin", "burkinabe": "burkina faso", "cape verdean": "cabo verde", "ivorian": "côte d'ivoire", "ivorians": "côte d'ivoire", "gambian": "gambia",
    "ghanaian": "ghana", "guinean": "guinea", "bissau-guinean": "guinea-bissau", "liberian": "liberia", "malian": "mali", "mauritanian": "mauritania",
    "nigerien": "niger", "nigerian": "nigeria", "senegalese": "senegal", "sierran": "sierra leone", "togolese": "togo",
    "cameroonian": "cameroon", "central african": "central african republic", "chadian": "chad", "congolese": "democratic republic of the congo",
    "equatoguinean": "equatorial guinea", "gabonese": "gabon", "sao tomean": "sao tome and principe",
    "burundian": "burundi", "comorian": "comoros", "djiboutian": "djibouti", "eritrean": "eritrea", "ethiopian": "ethiopia", "kenyan": "kenya", "rwandan": "rwanda",
    "somali": "somalia", "somalian": "somalia", "somalians": "somalia", "south african": "south africa", "tanzanian": "tanzania", "ugandan": "uganda",
    "angolan": "angola", "botswanan": "botswana", "basotho": "lesotho", "malawian": "malawi", "mauritian": "mauritius", "mozambican": "mozambique", "namibian": "namibia",
    "seychellois": "seychelles", "swazi": "eswatini", "eswatinian": "eswatini", "zambian": "zambia", "zimbabwean": "zimbabwe",
}

# Labels of the text classifier.
IMPACT_LABELS = ["death", "injury", "displacement", "missing", "disease", "economic_loss", "conflict", "weather_shock", "policy_change", "none"]
RESOURCE_LABELS = ["food", "water", "cash_aid", "healthcare", "shelter", "livelihoods", "education", "infrastructure", "none"]
URGENCY_LABELS = ["low", "moderate", "high", "unclear"]
