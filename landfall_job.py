"""Script for ``spark-submit`` (ship the package with ``--py-files landfall.zip``):

    spark-submit --py-files landfall.zip landfall_job.py load --feed providers --input_path ... --lake ... --audit ...
"""

import sys

from landfall.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
