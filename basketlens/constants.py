"""Fixed values of the domain.

Everything in this module is prescribed by the data contract: names, weights,
limits and labels that results must carry exactly.
"""

# Event types and their implicit-feedback weights.
VIEW, CART, PURCHASE = "view", "cart", "purchase"
EVENT_TYPES = [VIEW, CART, PURCHASE]
WEIGHTS = {VIEW: 1, CART: 3, PURCHASE: 5}

UNKNOWN = "unknown"
MISSING_CATEGORY = "__MISSING__"

# Rule segments of user profiles.
LOYAL = "Loyal Whales"
ABANDONER = "Cart Abandoners"
POWER = "Power Browsers"
CASUAL = "Casual Browsers"

# Cluster id -> (label, description, recommended action).
SEGMENTS = {
    0: ("Window Shoppers", "Browse heavily but rarely purchase", "Offer first-purchase discounts"),
    1: ("Cart Abandoners", "Add to cart but don't complete purchase", "Send cart recovery emails"),
    2: ("Casual Buyers", "Moderate engagement with occasional purchases", "Loyalty program enrollment"),
    3: ("Loyal Whales", "High-value repeat customers", "VIP treatment, exclusive access"),
    4: ("Bargain Hunters", "Price-sensitive, purchase during sales", "Targeted sale notifications"),
}

# Inputs of customer segmentation.
SEGMENT_FEATURES = [
    "total_sessions",
    "avg_session_duration_min",
    "total_views",
    "total_carts",
    "total_purchases",
    "avg_order_value",
    "cart_abandonment_rate",
    "category_diversity",
    "brand_diversity",
    "purchase_frequency",
]

# Inputs of profile clustering.
PROFILE_FEATURES = [
    "total_events",
    "total_spend",
    "purchases",
    "cart_adds",
    "views",
    "unique_products",
    "category_diversity",
    "avg_price_viewed",
    "cart_abandonment_rate",
]

# Click rows: one label, 13 numeric and 26 categorical features.
CTR_LABEL = "label"
CTR_NUMERIC = [f"I{i}" for i in range(1, 14)]
CTR_CATEGORICAL = [f"C{i}" for i in range(1, 27)]
HASH_BUCKETS = 2**18

# Columns a live event must carry.
LIVE_REQUIRED = [
    "event_time",
    "event_type",
    "product_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "session_id",
]

SESSION_GAP_MINUTES = 30
