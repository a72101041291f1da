"""Map layers as Spark tables: attach, define by SQL, request, measure, join by place, aggregate, store."""

from lamina.functions.registry import register_functions
from lamina.session import local_session
from lamina.sources.layer import AttributeJoin, Layer, LayerDef, Source, create_layer, open_layer

__all__ = [
    "AttributeJoin", "Layer", "LayerDef", "Source", "create_layer", "local_session", "open_layer", "register_functions",
]
