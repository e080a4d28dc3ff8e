"""Every list, threshold and text that results depend on.

Nothing here is logic.  The values below must be exactly these for results to
match the data this project reads and writes.
"""

# ---- fixed values: enumerated domains -------------------------------------
ACTION_TYPES = [
    "click", "double_click", "right_click", "long_press", "type", "key", "scroll",
    "swipe", "drag", "wait", "screenshot", "done", "fail",
]
CLICK_FAMILY = ["click", "double_click", "right_click"]
TERMINAL_ACTIONS = ["done", "fail"]
NO_EFFECT_CHECK = ["done", "fail", "wait", "screenshot"]

SAMPLE_STATES = [
    "raw", "validating", "quarantined", "enriching", "enriched", "annotating",
    "annotated", "approved", "rejected", "exported",
]
SOURCE_TYPES = ["human_demo", "synthetic", "tutorial", "self_play", "correction", "replay"]
STAGE_GROUNDING = "stage1_grounding"
STAGE_ACTION = "stage2_action"
STAGE_PLANNING = "stage3_planning"
STAGE_ALL = "all_stages"
EXPORT_STAGES = [STAGE_GROUNDING, STAGE_ACTION, STAGE_PLANNING]

# ---- fixed values: tag inference, in output order --------------------------
TAG_KEYWORDS = {
    "email": ["email", "gmail", "outlook", "inbox", "message"],
    "browser": ["chrome", "browser", "navigate", "search", "url"],
    "file": ["file", "folder", "save", "open", "document"],
    "form": ["form", "fill", "input", "submit", "register"],
    "android": ["android", "phone", "mobile", "app"],
    "multilingual": ["urdu", "pashto", "arabic", "hindi"],
}

# ---- fixed values: validation thresholds -----------------------------------
MIN_TASK_CHARS = 5
MIN_IMAGE_KB = 5.0
MIN_IMAGE_WIDTH = 400
MIN_IMAGE_HEIGHT = 300
MIN_PIXEL_VARIANCE = 50.0

# ---- fixed values: duplicate detection -------------------------------------
HASH_BITS = 256
NEAR_DISTANCE = 8
NEAR_TASK_JACCARD = 0.5
NEAR_COORDINATE = 0.15
TASK_WORDS = 20
DEDUP_INDEX_VERSION = 2

# ---- fixed values: language marker words ------------------------------------
URDU_WORDS = [
    "کھولیں", "بند", "ارسال", "ای", "میل", "کریں", "نیا", "فائل", "ترتیبات",
    "پاس", "ورڈ", "لاگ", "ان", "آؤٹ", "تلاش", "محفوظ",
]
PASHTO_WORDS = ["خلاص", "وتل", "لیدل", "کول", "لیږل", "ټولګه", "پاسوورډ"]
ARABIC_WORDS = ["افتح", "أغلق", "إرسال", "بريد", "ملف", "جديد", "حفظ", "بحث"]

# ---- fixed values: text-region filters --------------------------------------
OCR_MIN_CONFIDENCE = 0.5
OCR_MIN_LENGTH = 3
OCR_MAX_REGIONS = 100
OCR_DEFAULT_MAX_REGIONS = 50
SHORT_TOKENS = [
    "ok", "id", "no", "go", "up", "kb", "mb", "gb", "ui", "c#", "vb", "py", "js",
    "db", "pc", "tv", "an", "or", "in", "at", "by", "of", "to", "if",
]
SHORT_TOKEN_VOWELS = "aeiouاوی"

# ---- fixed values: difficulty ------------------------------------------------
HARD_KEYWORDS = [
    "filter", "sort", "search", "find", "compare", "multiple", "all", "every",
    "between", "before", "after", "export", "import", "configure", "settings",
    "advanced", "recover", "undo", "restore", "merge", "split",
]
MEDIUM_KEYWORDS = [
    "reply", "forward", "attach", "compose", "create", "save", "open", "close",
    "navigate", "select", "download", "upload", "copy", "paste", "move",
]
ACTION_COMPLEXITY = {
    "click": 1, "double_click": 1, "right_click": 2, "type": 2, "key": 2,
    "scroll": 1, "wait": 1, "done": 0, "fail": 0,
}

# ---- fixed values: quality score and routing ---------------------------------
WEIGHT_VALIDATION = 0.30
WEIGHT_REASONING = 0.35
WEIGHT_OCR = 0.20
WEIGHT_DIVERSITY = 0.15
QUALITY_THRESHOLD = 0.65
STAGE_MIN_SCORE = {STAGE_GROUNDING: 0.60, STAGE_ACTION: 0.62, STAGE_PLANNING: 0.80}
PLANNING_MIN_STEP = 5
PLANNING_MIN_REASONING = 150

# ---- fixed values: trajectory analysis ----------------------------------------
LOOP_WINDOWS = [2, 3, 4]
LOW_DIVERSITY_RATIO = 0.8
TRAJECTORY_THRESHOLD = 0.6

# ---- fixed values: annotation --------------------------------------------------
PROVIDER_PRIORITY = ["groq", "google", "openrouter"]
MIN_REASONING_CHARS = 30
VERIFIED_CONFIDENCE = 0.80
UNVERIFIED_CONFIDENCE = 0.60
FALLBACK_CONFIDENCE = 0.25
INLINE_IMAGE_KB = 300

REASONING_SYSTEM_TEMPLATE = """You are an expert GUI automation annotator for {agent}, an AI agent that controls computer interfaces.

Your job is to write high-quality reasoning annotations for agent actions.
These annotations become training data that teaches future AI models how to think before acting.

CRITICAL RULES:
1. Only reference UI elements that appear in the OCR text provided
2. Never invent elements that are not in the OCR data
3. Write from the agent's perspective ("I can see...", "I need to...")
4. Be specific about coordinates and elements
5. Explain WHY this action, not just WHAT it is
6. Keep reasoning between 2-5 sentences

OUTPUT FORMAT (JSON only, no markdown, no explanation):
{{
  "reasoning": "string — the chain-of-thought reasoning",
  "intent": "string — one sentence: what goal does this action serve?",
  "verified": true/false — are all elements mentioned actually in the OCR text?
}}"""

DIFFICULTY_SYSTEM_TEXT = """You are an expert at rating the difficulty of GUI automation tasks.

Rate difficulty on a scale of 1-5:
  1 = Trivial: single obvious action, no decision needed (click visible button)
  2 = Easy: clear sequence, no ambiguity (type text in focused field)
  3 = Medium: requires reading screen state, mild decision (find correct tab)
  4 = Hard: complex navigation, multiple conditions (find email by date filter)
  5 = Expert: multi-step reasoning, error recovery, rare scenarios

OUTPUT FORMAT (JSON only):
{
  "difficulty": integer 1-5,
  "reason": "one sentence explaining the rating"
}"""

# ---- fixed values: export texts (the agent's name is an option) ------------------
AGENT_NAME = "the assistant"
STAGE_PROMPTS = {
    STAGE_GROUNDING: (
        "You are {agent}, an AI agent that controls computer interfaces. "
        "Given a screenshot and a target element, output the normalized "
        "coordinates [x, y] where x and y are between 0.0 and 1.0. "
        "Think step by step inside <think>...</think> tags, "
        "then output your action inside <action>...</action> as JSON."
    ),
    STAGE_ACTION: (
        "You are {agent}, an AI agent that controls computer interfaces. "
        "Given a screenshot, a task, and screen content, decide the single "
        "best next action to take. "
        "Think step by step inside <think>...</think> tags, "
        "then output your action inside <action>...</action> as JSON."
    ),
    STAGE_PLANNING: (
        "You are {agent}, an AI agent that controls computer interfaces. "
        "Given a screenshot, a multi-step task, previous actions, and screen "
        "content, reason about the overall plan and decide the best next action. "
        "Think step by step inside <think>...</think> tags, "
        "then output your action inside <action>...</action> as JSON."
    ),
}
LEGACY_SYSTEM_TEMPLATE = """You are {agent}, an AI agent that controls computer interfaces.

You receive a screenshot of the current screen and a task to complete.

You MUST respond with exactly two blocks:

<think>
Analyse the screen carefully.
What do you see? What UI elements are visible?
What is the best next single action to make progress on the task?
</think>

<action>
{{"type": "ACTION_TYPE", "coordinates": [x, y], "text": "...", "description": "..."}}
</action>

ACTION TYPES:
  click        → {{"type":"click","coordinates":[x,y],"description":"..."}}
  double_click → {{"type":"double_click","coordinates":[x,y],"description":"..."}}
  right_click  → {{"type":"right_click","coordinates":[x,y],"description":"..."}}
  type         → {{"type":"type","text":"your text here","description":"..."}}
  key          → {{"type":"key","key":"win+r","description":"..."}}
  scroll       → {{"type":"scroll","direction":"down","amount":3,"description":"..."}}
  wait         → {{"type":"wait","duration_ms":2000,"description":"..."}}
  done         → {{"type":"done","description":"Task completed because..."}}
  fail         → {{"type":"fail","description":"Cannot complete because..."}}

RULES:
  - coordinates are ALWAYS normalized floats between 0.0 and 1.0
  - [0.0, 0.0] = top-left corner of screen
  - [1.0, 1.0] = bottom-right corner of screen
  - [0.5, 0.5] = center of screen
  - always think before acting
  - use done when task is fully complete
  - use fail only when task is truly impossible
"""
NEAREST_REGIONS = 20
RAW_TEXT_CHARS = 300
REQUEST_TEXT_CHARS = 800
REGISTRY_TASK_CHARS = 500

# ---- fixed values: risk ------------------------------------------------------------
RISK_NAMES = ["SAFE", "LOW", "MEDIUM", "HIGH", "BLOCKED"]
RISK_BASE = {
    "screenshot": 0, "wait": 0, "scroll": 0, "done": 0, "fail": 0,
    "click": 1, "double_click": 1, "right_click": 1, "key": 1, "drag": 1,
    "swipe": 1, "long_press": 1, "type": 2,
}
RISKY_CLICK_WORDS = [
    "delete", "remove", "buy", "purchase", "send", "pay", "confirm", "checkout",
    "uninstall",
]
RISKY_TYPE_WORDS = ["password", "card", "cvv", "ssn", "secret", "token"]

# ---- fixed values: screen change ------------------------------------------------------
PIXEL_CHANGE = 30
ACTIVE_REGION = 0.05
SIGNIFICANT_CHANGE = 0.01
SCREEN_REGIONS = [
    "top_left", "top_center", "top_right",
    "middle_left", "center", "middle_right",
    "bottom_left", "bottom_center", "bottom_right",
]
GRID_CUTS = [0.0, 0.33, 0.67, 1.0]

# ---- fixed values: plans ---------------------------------------------------------------
PLAN_STEPS = {
    "open": [
        "Find the target app or file", "Click to open it", "Wait for it to load",
        "Verify it opened successfully",
    ],
    "search": [
        "Open the search interface", "Click the search field", "Type the search query",
        "Press Enter", "Wait for results",
    ],
    "login": [
        "Navigate to the login page", "Enter username", "Enter password", "Click login",
        "Verify login succeeded",
    ],
    "fill": [
        "Identify all form fields", "Fill each field in order",
        "Review the filled values", "Submit the form", "Verify submission",
    ],
    "click": ["Locate the target element", "Click on it", "Verify the action worked"],
    "type": [
        "Find the input field", "Click to focus it", "Type the text",
        "Verify text was entered",
    ],
    "scroll": [
        "Determine scroll direction", "Scroll to reveal content",
        "Verify target is visible",
    ],
}
GENERIC_PLAN = [
    "Analyse the current screen state", "Identify the action needed for the task",
    "Execute the action", "Verify the result", "Continue until task is complete",
]
