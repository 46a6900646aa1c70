"""Fixed values that must equal the analysed study's for identical results.

Everything below is data, stated once in its natural order.  Operators take
these as defaults and accept any other table of the same shape.
"""

# --- FIXED VALUES (must match the study) -----------------------------------

# The currency that amounts are converted to.
BASE_CURRENCY = "KZT"

# Currency conversion to KZT, checked in this order against the upper-cased
# currency code by substring; anything else is left unconverted.
CURRENCY_RULES = [
    (("USD",), 480.0),
    (("EUR",), 520.0),
    (("RUB", "RUR"), 5.2),
]

# City families: lower-cased area contains any of the spellings -> city.
# Checked in order; no match (or null) -> "Other".
CITY_RULES = [
    ("Almaty", ["алматы", "almaty", "алма-ата"]),
    ("Astana", ["астана", "astana", "нур-султан", "nur-sultan"]),
    ("Shymkent", ["шымкент", "shymkent", "чимкент"]),
    ("Karaganda", ["караганд", "karagand"]),
    ("Aktobe", ["актобе", "aktobe", "aqtobe"]),
    ("Taraz", ["тараз", "taraz"]),
]
CITY_DEFAULT = "Other"

# Experience label -> ordinal level; unknown or missing -> 0.
EXPERIENCE_LEVELS = {
    "Нет опыта": 0,
    "От 1 года до 3 лет": 1,
    "От 3 до 6 лет": 2,
    "Более 6 лет": 3,
}
# Ordinal level -> English label used in reports.
EXPERIENCE_LABELS = {0: "No Experience", 1: "1-3 years", 2: "3-6 years", 3: "6+ years"}

# Dictionary of technical terms searched in free text (104 terms).
TECH_TERMS = [
    "Python", "Java", "JavaScript", "TypeScript", "C++", "C#", "Go", "Rust",
    "PHP", "Ruby", "Swift", "Kotlin", "Scala", "R", "MATLAB",
    "React", "Vue", "Vue.js", "Angular", "HTML", "CSS", "SASS", "LESS",
    "jQuery", "Bootstrap", "Tailwind", "Next.js", "Nuxt.js",
    "Django", "Flask", "FastAPI", "Node.js", "Express", "Spring", "Spring Boot",
    "Laravel", "ASP.NET", "Ruby on Rails", "Nest.js",
    "PostgreSQL", "MySQL", "MongoDB", "Redis", "Elasticsearch",
    "Oracle", "SQL Server", "SQLite", "Cassandra", "DynamoDB",
    "Docker", "Kubernetes", "AWS", "Azure", "Google Cloud", "GCP",
    "Jenkins", "GitLab CI", "GitHub Actions", "Terraform", "Ansible",
    "Linux", "Nginx", "Apache",
    "Android", "iOS", "React Native", "Flutter", "Xamarin",
    "Machine Learning", "Deep Learning", "TensorFlow", "PyTorch",
    "Scikit-learn", "Pandas", "NumPy", "Jupyter", "Data Science",
    "Computer Vision", "NLP", "Natural Language Processing",
    "Git", "GitHub", "GitLab", "Jira", "Confluence", "Agile", "Scrum",
    "REST API", "GraphQL", "Microservices", "CI/CD", "TDD", "Unit Testing",
    "Blockchain", "Solidity", "Ethereum", "Smart Contracts",
    "Unity", "Unreal Engine", "3D Graphics",
    "Photoshop", "Figma", "UI/UX", "Design",
]

# Remote-work pattern on the schedule text (case-insensitive).
REMOTE_PATTERN = "удаленн|remote|дистанц"

# Regions compared in the regional study.
MAJOR_CITIES = ["Almaty", "Astana", "Shymkent", "Other"]

# Skills taught by the curriculum (category gap study).
TAUGHT_SKILLS = [
    "Python", "Java", "JavaScript", "TypeScript", "Go",
    "Docker", "Kubernetes", "CI/CD", "GitLab CI", "Jenkins", "Linux",
    "Git", "GitHub", "GitLab", "Agile", "Scrum", "Jira",
    "React", "Vue", "Angular", "HTML", "CSS",
    "Android", "iOS", "Django", "Spring", "REST API",
    "PostgreSQL", "MySQL", "SQL",
    "Design", "UI/UX",
    "Machine Learning", "Deep Learning", "Data Mining",
    "AWS", "Azure", "Blockchain",
]

# Skill categories of the gap study, in report order.
SKILL_CATEGORIES = [
    ("DevOps & CI/CD", ["Docker", "Kubernetes", "CI/CD", "Git", "GitLab CI", "Jenkins"]),
    ("NoSQL Databases", ["Redis", "MongoDB", "Elasticsearch"]),
    ("Frontend", ["TypeScript", "React", "Vue", "HTML", "CSS"]),
    ("Mobile", ["Android", "iOS"]),
    ("Backend", ["Python", "Java", "Django", "Spring"]),
    ("Methodologies", ["Git", "Agile", "Scrum"]),
]

# Gap status bands: gap < 0, < 10, < 20, else.
GAP_BANDS = ([0.0, 10.0, 20.0], ["EXCELLENT", "GOOD", "MEDIUM", "HIGH"])

# Advisor: curriculum as slugs, critical gaps and the two career paths.
ADVISOR_TAUGHT = [
    "python", "java", "javascript", "typescript", "go",
    "docker", "kubernetes", "ci/cd", "gitlab_ci", "jenkins", "linux",
    "git", "github", "gitlab", "agile", "scrum", "jira",
    "react", "vue", "angular", "html", "css",
    "android", "ios", "django", "spring", "rest_api",
    "postgresql", "mysql", "sql",
    "machine_learning", "deep_learning", "data_mining",
    "aws", "azure",
]
CRITICAL_GAPS = ["redis", "mongodb", "elasticsearch"]
CAREER_PATHS = [
    ("DevOps/Infrastructure Specialist",
     ["docker", "ci/cd", "postgresql", "git", "redis", "kubernetes", "jenkins", "gitlab_ci"]),
    ("General Software Developer",
     ["git", "linux", "javascript", "python", "agile", "java", "react", "sql"]),
]
# Path chosen on a tie (the second path wins unless the first is strictly greater).
CAREER_PATH_DEFAULT = "General Software Developer"

# Percentile bands of a predicted salary: >= 75, >= 50, >= 25, else.
PERCENTILE_BANDS = ([25.0, 50.0, 75.0], ["ENTRY LEVEL", "DEVELOPING", "GOOD", "EXCELLENT"])
# Premium tiers: >= 200 000, >= 100 000, else.
PREMIUM_BANDS = ([100000.0, 200000.0], ["standard", "high", "top"])
# Significance stars: p < 0.001, < 0.01, < 0.05.
STAR_BANDS = ([0.001, 0.01, 0.05], ["***", "**", "*", ""])

# Self-study hours for the action plan; group defaults by text.
EFFORT_HOURS = {"redis": "20", "mongodb": "30", "elasticsearch": "40"}
EFFORT_GROUP = (["docker", "kubernetes", "ci/cd"], "40-60")
EFFORT_DEFAULT = "30-50"

# Rows that a sample for a test holds at most.
SAMPLE_ROWS = 5000

# Model settings of the valuation study.
RIDGE_ALPHA = 1.0
LASSO_ALPHA = 1.0
FOREST_TREES = 100
GBT_ROUNDS = 100
GBT_STEP = 0.1
GBT_DEPTH = 3
SPLIT_SEED = 42
TRAIN_FRACTION = 0.8
CV_FOLDS = 5
BLEND_WEIGHTS = (0.6, 0.4)  # forest, boosting
INTERVAL_Z = 1.96
TOP_N_SKILLS = 50
IQR_K = 1.5
MIN_SUPPORT = 0.05
MIN_CONFIDENCE = 0.5
KMEANS_STARTS = 10
KMEANS_K = 2
KMEANS_SWEEP = list(range(2, 11))
