import json

from .cli import main

print(json.dumps(main(), indent=2))
