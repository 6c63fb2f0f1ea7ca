"""Explicit schemas (Spark DDL) of the records the engine reads."""

# Field names of the input records.
POST = """
    id STRING, source STRING, subreddit STRING, author STRING, title STRING, selftext STRING, text STRING,
    score BIGINT, num_comments BIGINT, created_utc BIGINT, link_flair_text STRING, permalink STRING,
    is_self BOOLEAN, keyword_matched STRING
"""

SUBMISSION = """
    id STRING, title STRING, selftext STRING, subreddit STRING, author STRING, score BIGINT, num_comments BIGINT,
    created_utc BIGINT, permalink STRING, full_link STRING, is_self BOOLEAN
"""

ANNOTATION = """
    id STRING, Information_Integrity STRING, Linguistic_Bias INT, Political_Bias INT, Gender_Bias INT,
    Hate_Speech INT, Racial_Bias INT, Casualty INT, Evacuation INT, Damage INT, Advice INT, Request INT,
    Assistance INT, Recovery INT
"""

STATUS = """
    id BIGINT, created_at STRING, lang STRING, text STRING,
    user STRUCT<screen_name: STRING, followers_count: BIGINT, friends_count: BIGINT, statuses_count: BIGINT,
                lang: STRING, location: STRING, time_zone: STRING>,
    entities STRUCT<hashtags: ARRAY<STRUCT<text: STRING>>,
                    user_mentions: ARRAY<STRUCT<screen_name: STRING>>,
                    urls: ARRAY<STRUCT<expanded_url: STRING>>,
                    media: ARRAY<STRUCT<media_url: STRING>>>,
    retweeted_status STRUCT<text: STRING>
"""

CORRUPT = "_corrupt_record"
