"""Fixed values that results depend on (word lists, rule tables, constants)."""

# English stop words, lower case.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
he him his himself she she's her hers herself it it's its itself they them their theirs themselves
what which who whom this that that'll these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over
under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don don't should should've
now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn
hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# A word, or one punctuation mark.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"

# Poll weights of the three answers.
POLL_WEIGHTS = {"Best": 1.0, "Recommended": 0.5, "Not Recommended": 0.0}

# Pipeline thresholds.
MIN_ITEM_RATINGS = 30
MIN_POLL_VOTES = 30
GOOD_PLAYER_RATIO = 0.5
MIN_USER_RATINGS = 5
QUALITY_TOKENS_TABLE = 10
QUALITY_TOKENS_SAMPLE = 5
SAMPLE_SHARE = 0.1
MIN_SAMPLE = 250
FRESH_DAYS = 30
IDS_PER_URL = 20
URL_GROUPS = 29
RATINGS_PER_PAGE = 100
RANK_BLOCK = 166
PLAYTIME_CAP = 480
RATING_CAP = 10.0
RANK_DEFAULT = 999999
ITEM_SUPPORT = 10
SIMILARITY_BAND = (0.75, 0.999)
SYNTHETIC_SIMILARITY = 0.8
RARE_THRESHOLDS = {"publisher": 3, "artist": 3, "designer": 2}

# Groups of mechanics that are merged under one name, by a substring.
MECHANIC_GROUPS = {
    "auction": "Auction or Bidding",
    "drafting": "Drafting",
    "worker": "Worker Placement",
    "tableau": "Tableau Building",
    "legacy": "Legacy Game",
}

# Family tags that also count as a mechanic.
FAMILY_MECHANICS = {
    "Mechanism: Legacy": "Legacy",
    "Mechanism: Tableau Building": "TableauBuilding",
}

# Weight of each group of features in the content model.
FEATURE_GROUP_WEIGHTS = {
    "mechanics": 0.75,
    "subcategories": 0.75,
    "themes": 0.5,
    "family": 0.5,
    "designers": 1.0,
    "categories": 1.0,
}

# Flag column written for each rank column that holds a number.
RANK_FLAGS = {
    "Rank:thematic": "Cat:Thematic",
    "Rank:strategygames": "Cat:Strategy",
    "Rank:wargames": "Cat:War",
    "Rank:familygames": "Cat:Family",
    "Rank:cgs": "Cat:CGS",
    "Rank:abstracts": "Cat:Abstract",
    "Rank:partygames": "Cat:Party",
    "Rank:childrensgames": "Cat:Childrens",
}

# Category names that are really mechanics, with the mechanic's name.
ACTUALLY_MECHANICS = {
    "Real-time": "Real-Time",
    "Bluffing": "Betting and Bluffing",
    "Deduction": "Deduction",
    "Dice": "Dice Rolling",
    "Memory": "Memory",
    "Negotiation": "Negotiation",
    "Exploration": "Exploration",
    "Territory Building": "Territory Building",
    "Action / Dexterity": "Action / Dexterity",
}

# Category names that are really themes.
ACTUALLY_THEMES = [
    "Adventure", "Age of Reason", "American Civil War", "American Indian Wars",
    "American Revolutionary War", "American West", "Ancient", "Animals", "Arabian",
    "Aviation / Flight", "City Building", "Civil War", "Civilization", "Comic Book / Strip",
    "Economic", "Environmental", "Fantasy", "Farming", "Fighting", "Horror", "Humor",
    "Industry / Manufacturing", "Korean War", "Mafia", "Math", "Mature / Adult", "Maze", "Medical",
    "Medieval", "Modern Warfare", "Movies / TV / Radio theme", "Murder/Mystery",
    "Murder / Mystery", "Music", "Mythology", "Napoleonic", "Nautical", "Novel-based", "Number",
    "Pike and Shot", "Pirates", "Political", "Post-Napoleonic", "Prehistoric", "Racing",
    "Religious", "Renaissance", "Science Fiction", "Space Exploration", "Spies/Secret Agents",
    "Spies / Secret Agents", "Sports", "Trains", "Transportation", "Travel", "Trivia",
    "Video Game Theme", "Vietnam War", "World War I", "World War II", "Zombies",
]

# Category names that set a major-category flag.
ACTUALLY_MAJOR_CATEGORIES = {
    "Wargame": "Cat:War",
    "Children's Game": "Cat:Childrens",
    "Party Game": "Cat:Party",
    "Abstract Strategy": "Cat:Abstract",
}

# Category names that are dropped.
DROP_SUBCATEGORIES = ["Expansion for Base-game", "Game System", "Book"]

# Columns dropped from the fact table when present.
DROP_COLUMNS = [
    "NumAwards", "NumFans", "NumPageViews", "RulesPosts", "TotalPosts", "Category",
    "Rank:rpgitem", "Rank:boardgameaccessory", "Rank:videogame", "Rank:amiga",
    "Rank:commodore64", "Rank:arcade", "Rank:atarist", "Setting", "Mechanism",
]

# Headings of a generated summary.
SUMMARY_ABOUT = "### What is this game about?\n"
SUMMARY_PROS = "\n\n### Pros\n"
SUMMARY_CONS = "\n\n### Cons\n"
