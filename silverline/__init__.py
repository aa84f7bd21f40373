"""silverline: Bronze -> Silver -> Gold for trending-video data on Spark.

Entry points: ``plans.videos.run_videos``, ``plans.categories.run_categories``,
``plans.gold.run_gold``, ``streaming.incremental.stream_api_videos`` /
``stream_categories``, and ``python -m silverline`` for the command line.
"""

__version__ = "0.1.0"
