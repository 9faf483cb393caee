from quayside.functions.coerce import *  # noqa: F401,F403
