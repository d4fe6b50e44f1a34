from civgraph.functions.columns import *  # noqa: F401,F403
from civgraph.functions.names import camel_to_snake, graph_id, graph_start, graph_end, typed  # noqa: F401
