"""Column names and schemas shared by every operator."""

USER = "user_id"
ITEM = "book_id"
RATING = "rating"
REVIEWED = "is_reviewed"
READ = "is_read"
SPLIT = "split"
TRAIN, VAL, TEST = "train", "val", "test"

TRIPLE = (USER, ITEM, RATING)

# The published input files have these columns, in this order.
INTERACTIONS_DDL = "user_id INT, book_id INT, is_read INT, rating INT, is_reviewed INT"
USER_MAP_DDL = "user_id_csv INT, user_id STRING"
BOOK_MAP_DDL = "book_id_csv INT, book_id STRING"

RESULTS_DDL = (
    "ts TIMESTAMP, fraction DOUBLE, split STRING, k INT, rank INT, lambda DOUBLE, "
    "weight DOUBLE, users BIGINT, map DOUBLE, ndcg DOUBLE, precision DOUBLE, "
    "fit_s DOUBLE, rec_s DOUBLE, eval_s DOUBLE, off_by DOUBLE"
)
