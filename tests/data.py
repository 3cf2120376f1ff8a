"""Small tables for the rules under test, made from short formulas."""

INTERACTION = "user_id INT, book_id INT, rating INT"


def few(spark):
    """Eight users with five of seventeen books each; ratings 0 to 5."""
    made = [(u, 200 + (5 * u + j * j) % 17, (u + 2 * j) % 6) for u in range(1, 9) for j in range(5)]
    return spark.createDataFrame(made, INTERACTION)


def few_reviewed(spark):
    return few(spark).selectExpr("*", "CAST((user_id + book_id) % 3 = 0 AS INT) AS is_reviewed")


def many(spark):
    """Users 1 to 45 with 3 to 11 books, zeros among the ratings, and a user with a single book of their own."""
    made = [(u, 700 + (7 * u + 11 * j) % 61, (u * j + 3) % 6) for u in range(1, 46) for j in range(3 + u % 9)]
    return spark.createDataFrame([*made, (46, 999, 5)], INTERACTION)
