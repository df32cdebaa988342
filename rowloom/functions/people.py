"""Name parts for generated persons."""

from __future__ import annotations

from typing import NamedTuple


class People(NamedTuple):
    """Given and family names to combine; pass your own for another locale."""

    given: tuple[str, ...]
    family: tuple[str, ...]


# Common given and family names in the United States.
GIVEN = (
    "Aaron Adam Alan Albert Alice Amanda Amber Amy Andrea Andrew Angela Ann Anna Anthony Arthur "
    "Ashley Austin Barbara Benjamin Betty Brandon Brenda Brian Bruce Carl Carol Catherine Charles "
    "Cheryl Christina Christopher Cynthia Daniel David Deborah Dennis Diana Donald Donna Dorothy "
    "Douglas Edward Elizabeth Emily Emma Eric Frances Frank Gary George Gerald Gloria Grace Gregory "
    "Hannah Harold Heather Helen Henry Jack Jacob James Janet Jason Jean Jeffrey Jennifer Jeremy "
    "Jessica Joan John Jonathan Joseph Joyce Juan Judith Julia Justin Karen Katherine Keith Kelly "
    "Kenneth Kevin Kimberly Larry Laura Lauren Lawrence Linda Lisa Madison Margaret Maria Mark Martha "
    "Mary Matthew Megan Michael Michelle Mildred Nancy Natalie Nathan Nicholas Nicole Noah Nora Olivia "
    "Oscar Pamela Patricia Patrick Paul Peter Philip Rachel Ralph Randy Raymond Rebecca Richard Robert "
    "Roger Ronald Rose Roy Russell Ruth Ryan Samantha Samuel Sandra Sara Sarah Scott Sean Sharon Shirley "
    "Sophia Stephanie Stephen Steven Susan Teresa Terry Theresa Thomas Timothy Tyler Victoria Vincent "
    "Virginia Walter Wayne William Willie Zachary Zoe"
).split()
FAMILY = (
    "Adams Allen Alvarez Anderson Bailey Baker Bennett Brooks Brown Campbell Carter Castillo Chavez "
    "Clark Collins Cook Cooper Cox Cruz Davis Diaz Edwards Evans Flores Foster Garcia Gomez Gonzalez "
    "Gray Green Gutierrez Hall Harris Hernandez Hill Howard Hughes Jackson James Jimenez Johnson Jones "
    "Kelly Kim King Lee Lewis Long Lopez Martin Martinez Mendoza Miller Mitchell Moore Morales Morgan "
    "Morris Murphy Myers Nelson Nguyen Ortiz Parker Patel Perez Peterson Phillips Price Ramirez Ramos "
    "Reed Reyes Richardson Rivera Roberts Robinson Rodriguez Rogers Ross Ruiz Sanchez Sanders Scott "
    "Smith Stewart Taylor Thomas Thompson Torres Turner Walker Ward Watson White Williams Wilson Wood "
    "Wright Young"
).split()

COMMON_PEOPLE = People(tuple(GIVEN), tuple(FAMILY))
