"""Small inputs with known results. Fixed values; times are epoch milliseconds."""

CLICKS_SCHEMA = "userId string, productId string, category string, price double, ts bigint, action string"
CLICKS = [
    ("u1", "p100", "electronics", 299.99, 1000, "view"),
    ("u1", "p100", "electronics", 299.99, 1500, "add_to_cart"),
    ("u1", "p100", "electronics", 299.99, 2000, "purchase"),
    ("u2", "p200", "books", 19.50, 2500, "purchase"),
    ("u3", "p300", "electronics", 799.00, 3000, "add_to_cart"),
    ("u3", "p300", "electronics", 799.00, 3500, "purchase"),
    ("u4", "p400", "clothing", 120.00, 4000, "add_to_cart"),
    ("u5", "p500", "electronics", 1299.00, 5000, "purchase"),
    ("u6", "p600", "books", 25.00, 6000, "purchase"),
    ("u7", "p700", "clothing", 89.99, 7000, "view"),
    ("u8", "p800", "clothing", 49.00, 8000, "add_to_cart"),
]
PROFILES = [("u1", "premium"), ("u2", "free"), ("u2", "vip"), ("u3", "premium"), ("u5", "vip")]

HISTORY_SCHEMA = "userId string, category string, price double, ts bigint"
HISTORY = [
    ("u1", "books", 12.0, 1000),
    ("u2", "toys", 8.0, 1001),
    ("u1", "toys", 9.0, 1002),
    ("u1", "books", 14.0, 1003),
    ("u2", "electronics", 200.0, 1004),
    ("u1", "electronics", 99.0, 1005),
    ("u1", "clothing", 30.0, 1006),
    ("u2", "books", 11.0, 1007),
]
HISTORY_RESULT = [
    ("u1", 1, ["books"]),
    ("u1", 2, ["books", "toys"]),
    ("u1", 3, ["books", "toys", "books"]),
    ("u1", 4, ["books", "toys", "books", "electronics"]),
    ("u1", 5, ["books", "toys", "books", "electronics", "clothing"]),
    ("u2", 1, ["toys"]),
    ("u2", 2, ["toys", "electronics"]),
    ("u2", 3, ["toys", "electronics", "books"]),
]

LATE_SCHEMA = "userId string, category string, price double, ts bigint"
LATE = [
    ("u1", "books", 12.0, 1000),
    ("u2", "electronics", 100.0, 1500),
    ("u1", "books", 8.0, 2500),
    ("u3", "books", 15.0, 4500),
    ("u4", "books", 20.0, 4000),
    ("u1", "electronics", 250.0, 5500),
    ("u2", "books", 11.0, 6000),
    ("u3", "electronics", 800.0, 8000),
    ("u5", "books", 3.0, 3000),
    ("u7", "electronics", 50.0, 9500),
    ("u6", "books", 99.0, 1000),
    ("u1", "books", 7.0, 11000),
    ("u2", "books", 13.0, 13500),
]

ORDERS_SCHEMA = "orderId string, userId string, category string, amount double, ts bigint"
ORDERS = [
    ("o1", "u1", "books", 12.0, 1000),
    ("o2", "u2", "electronics", 80.0, 1500),
    ("o3", "u1", "books", 8.0, 2000),
    ("o4", "u3", "electronics", 100.0, 2500),
    ("o5", "u2", "clothing", 25.0, 3000),
    ("o6", "u1", "books", 15.0, 4500),
    ("o7", "u3", "electronics", 60.0, 6000),
    ("o8", "u2", "clothing", 40.0, 7500),
    ("o9", "u1", "books", 20.0, 8000),
    ("o10", "u3", "clothing", 30.0, 11000),
    ("o11", "u2", "electronics", 90.0, 12000),
    ("o12", "u1", "books", 11.0, 13500),
]
TOTALS = {"books": 66.0, "electronics": 330.0, "clothing": 95.0}

PRICES = [10.0, 75.0, 350.0, 5000.0, 25.0, 150.0, 2500.0, 800.0]
PRICE_BUCKETS = [0, 1, 2, 3, 0, 1, 3, 2]

NAMES = {"u0": "Alice", "u1": "Bob", "u2": "Carol", "u3": "Dave"}
