"""Fixed values of the marketplace domain. They decide results and must stay as they are."""

from datetime import date

CUTOFF = date(2026, 4, 9)
REAL_CONTACTS = ["view_phone", "contact_chat", "contact_zalo", "contact_sms"]
POSITIVE_EVENTS = [*REAL_CONTACTS, "other_interaction"]
EVENT_WEIGHTS = {"pageview": 1.0, "other_interaction": 1.5, "view_phone": 5.0, "contact_chat": 5.0, "contact_zalo": 5.0, "contact_sms": 5.0, "lead": 10.0}
HALF_LIFE_DAYS = 7.0
AGENT_SHARE = 0.52
CATEGORY_SHARES = {1010: 0.156, 1020: 0.446, 1030: 0.065, 1040: 0.102, 1050: 0.231}
SESSION_ITEMS = (2, 30)
POOL_SIZE, TOP_K = 200, 10
ITEMS_PER_SELLER = 50
BUDGETS_TOP10 = {"als": 10, "intent": 10, "cocontact": 5, "pv": 3, "user_knn": 3, "seller": 3, "als_view": 0, "recent_cc": 10}
BUDGETS_POOL = {"pv": 50, "intent": 60, "cocontact": 40, "als": 100, "als_view": 0, "user_knn": 50, "seller": 40, "recent_cc": 80}
ORDER_TOP10 = ["als", "intent", "cocontact", "pv", "user_knn", "seller", "recent_cc", "segpop"]
ORDER_POOL = ["pv", "intent", "cocontact", "als", "als_view", "user_knn", "seller", "recent_cc", "segpop"]
