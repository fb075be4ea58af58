"""Fixed values of the recommender: thresholds, list sizes, markers and table names."""

# Marker that opens a rating record inside an application log line.
RATING_MARKER = "PRODUCT_RATING_PREFIX:"

# Similarity kept in stored lists, similarity that counts in real-time scoring,
# and the score above which a rating counts as "high".
STORED_SIMILARITY = 0.4
REALTIME_SIMILARITY = 0.6
HIGH_SCORE = 3.0

# List lengths.
USER_LIST_SIZE = 20
CANDIDATE_LIST_SIZE = 20
RECENT_RATINGS = 20
RECENT_QUEUE = 40

# Production setting and tuning grid of the factor model.
ALS_RANK, ALS_ITERATIONS, ALS_REG = 5, 10, 0.01
ALS_GRID_RANKS = (5, 10, 20, 50)
ALS_GRID_REGS = (1.0, 0.1, 0.01)
TEST_SHARE = 0.2

# Names of the stored tables.
PRODUCT = "Product"
RATING = "Rating"
RATE_MORE = "RateMoreProducts"
RATE_MORE_RECENTLY = "RateMoreRecentlyProducts"
AVERAGE = "AverageProducts"
USER_RECS = "UserRecs"
PRODUCT_RECS = "ProductRecs"
STREAM_RECS = "StreamRecs"
ITEM_CF_RECS = "ItemCFProductRecs"
CONTENT_RECS = "ContentBasedProductRecs"

# Tables of the real-time path: item vectors, the products each user has rated, ratings as they are
# now, each user's recent ratings, and payloads that are no rating.
ITEM_VECTORS = "ItemVectors"
RATED = "RatedProducts"
LIVE_RATING = "LiveRating"
RECENT_QUEUES = "RecentQueues"
REJECTED_PAYLOAD = "RejectedPayload"

# Lines of the input files that are no product or rating.
REJECTED_PRODUCT = "RejectedProduct"
REJECTED_RATING = "RejectedRating"

# Epoch values from here on are milliseconds, below it seconds.
MILLISECOND_FLOOR = 100_000_000_000

# Sums of doubles depend on the order of addition; rounding them before ranking makes every
# ranking the same under any partitioning.
SCORE_DIGITS = 9
