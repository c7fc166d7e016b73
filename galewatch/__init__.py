"""Crisis-message analytics as plain DataFrame -> DataFrame functions on Spark.

Nothing runs at import time and no session is created here: the caller passes
frames in and decides when to act on the frames that come back.
"""
